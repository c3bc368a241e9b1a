"""The pipeline against brute force, and the guard around the subpackage."""

import os
import subprocess
import sys

from pyspark.sql import functions as F
from tests.llm.helpers import SMALL, VOCABULARY, check_pieces, least_linked, odd
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import stages

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _expected(docs):
    """id -> text of the documents that the first three stages keep."""
    kept, seen = {}, set()
    for i, text in sorted((r.doc_id, r.text or "") for r in docs):
        norm = " ".join(text.split())
        if any(c.isalpha() for c in text) and norm not in seen:
            seen.add(norm)
            kept[i] = text
    return {i: kept[i] for i, least in least_linked(list(kept.items()), 5, 80).items() if i == least}


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    kept = _expected(docs)
    assert 0 < len(kept) < len(docs)
    library = Tokenizer.from_file(VOCABULARY)
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in kept.items()}
    assert check_pieces(pieces, ids) < 1024 * len({p.sequence_id >> 32 for p in pieces})


def test_stages_keep_the_columns_and_survive_odd_rows(spark, tmp_path):
    docs, plain = odd(spark), None
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(n))
        docs.write.parquet(path)
        plain = spark.read.parquet(path)
        docs = stage(spark, plain, SMALL)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == plain.columns
    assert {p.doc_id for p in docs.collect()} == {None, 4, 6, 8}
    empty = plain.limit(0)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"empty{n}")
        empty.write.parquet(path)
        assert stage(spark, spark.read.parquet(path), SMALL).count() == 0


def test_packing_follows_the_mixed_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = str(tmp_path / "mixed")
    stages.mix_sources(spark, docs, SMALL).write.parquet(path)
    written = spark.read.parquet(path)
    order = [
        r.source for r in written.select("source", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
        .orderBy("f", "i").collect()
    ]
    assert len(order) == docs.count()
    pieces = stages.pack_sequences(spark, written, SMALL).collect()
    first = min((p for p in pieces), key=lambda p: (p.sequence_id, p.offset))
    source = docs.where(F.col("doc_id") == first.doc_id).first().source
    assert source == order[0]


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the corpus folders still lists its other queries."""
    import shutil

    for name in ("__spark_entry__.py", "shelfcast"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, pipeline, operators = done.stdout.split()
    assert int(n) > 200 and pipeline == operators == "False"


def test_entry_works_without_a_library_of_the_subpackage():
    code = (
        "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); "
        "print(len(q), any(n.startswith('op') for n in q), len(e.oracle_sql()) > 200)"
    )
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, operators, oracles = done.stdout.split()
    assert int(n) > 200 and operators == "False" and oracles == "True"
