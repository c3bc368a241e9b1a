"""Pipeline over `documents`: each stage's rows are written as Parquet and read by the next.

Stages: language identification (texts without a known language go), exact copies, near
copies, mixing to target weights, packing into sequences.
"""

from shelfcast.llm import stages
from shelfcast.session import scratch_path, ship_package

STAGES = [
    ("language_id", stages.keep_known_language),
    ("exact_dedup", stages.drop_exact_copies),
    ("ngram_jaccard", stages.drop_near_copies),
    ("source_mix", stages.mix_sources),
    ("retrieval_packing", stages.pack_sequences),
]

#: Learned profiles and tokenisers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
