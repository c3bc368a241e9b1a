"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from pyspark.sql import functions as F

from shelfcast.llm import exact, jaccard, language, mixing, packing
from shelfcast.llm.queries import vocabulary

#: Bytes of text that are packed together.
SHARD_BYTES = 4_000_000


def keep_known_language(spark, docs, sf_dir):
    """Documents in one of the languages learned from `lang`; those without a letter go.

    A short text may resemble its language only a little, so no least cosine is asked for.
    Where no row names a language nothing can be learned, and all documents stay.
    """
    profiles = language.fit_profiles(docs, dimensions=1024)
    if not profiles.languages:
        return docs
    judged = language.identify(docs, profiles, prefix="__")
    return judged.where(F.col("__lang_pred") != language.UNKNOWN).select(*docs.columns)


def drop_exact_copies(spark, docs, sf_dir):
    """One row of each group of equal texts: the smallest id."""
    return exact.keep_one(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group linked by a Jaccard index of 0.8 over runs of five words."""
    return jaccard.drop_similar(docs, size=5, top=80, bottom=100)


def mix_sources(spark, docs, sf_dir):
    """All documents, written in mixed order: file after file, row after row."""
    mixed = mixing.mix(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = mixed.repartitionByRange(parts, "position").sortWithinPartitions("position")
    return ordered.select(*docs.columns)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of sequences (see packing.pack), numbered in the mixed order of their first documents.

    `docs` are Parquet files in that order: the place of a row is its file and its row number
    there. Seeds come in that order and their neighbours from all documents.
    """
    placed = docs.select(
        "doc_id", "text", F.col("_metadata.row_index").alias("row"),
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"),
    )
    place = F.col("file") * 2**26 + F.col("row")
    return packing.pack(
        placed, vocabulary(), shard_bytes=SHARD_BYTES, place=place, order=[F.col("file"), F.col("row")]
    )
