"""Exact deduplication: 128-bit content hash, smallest id stays, bytes compared inside groups."""

from pyspark.sql import functions as F

from shelfcast.llm.arrow import apart, carried, quoted

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
#: Runs of these bytes (space, tab to carriage return) become one space.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text):
    """Null as the empty text, every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def mark_copies(docs, doc_id="doc_id", text="text"):
    """All columns of `docs` with keep_id, group_size, kept and text_sha256.

    Rows whose texts are equal once normalised form a group; the row with the smallest id
    stays. The first aggregation has the 128-bit hash and the normalised bytes as its key,
    so texts of one hash are told apart by their bytes, and copies collapse before the
    shuffle however many there are. The way back to the rows needs no text: hash and SHA-256
    together name the group (two different texts would have to agree in both).

    A null text counts as empty. Null ids: a group whose ids are all null has keep_id null
    and all its rows stay; else a null id never stays. Repeated rows of the kept id all
    stay, as nothing tells them apart, and each counts in group_size. Columns of the result's
    names that were there before, in whatever case, are replaced.
    """
    return apart(docs, {"doc_id": doc_id, "text": text}, ADDED, _marked)


def _marked(rows, doc_id="doc_id", text="text"):
    norm = F.col("__norm")
    keyed = rows.withColumn("__norm", normalised(F.col(text))).withColumns(
        {"__hash": F.unhex(F.md5(norm)), "text_sha256": F.sha2(norm, 256)}
    ).drop("__norm")
    texts = rows.select(F.col(doc_id).alias("__id"), normalised(F.col(text)).alias("__norm"))
    groups = (
        texts.groupBy(F.unhex(F.md5(norm)).alias("__hash_of"), "__norm")
        .agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("__hash_of", F.sha2(norm, 256).alias("__sha_of"), "keep_id", "group_size")
    )
    joined = keyed.join(
        groups,
        (F.col("__hash") == F.col("__hash_of")) & (F.col("text_sha256") == F.col("__sha_of")),
    )
    kept = F.col(doc_id).eqNullSafe(F.col("keep_id"))
    return joined.withColumn("kept", kept).select(*rows.columns, *ADDED)


def drop_copies(docs, doc_id="doc_id", text="text"):
    """The rows of `docs` that stay, its columns unchanged."""
    return _kept(docs, doc_id, text).select("__row.*")


def _kept(docs, doc_id, text):
    plain = carried(docs, key=quoted(doc_id), text=quoted(text))
    return mark_copies(plain, "key", "text").where("kept").withColumnRenamed("row", "__row")


def keep_one(docs, doc_id="doc_id", text="text"):
    """Exactly one row of each group, its columns unchanged.

    Unlike in drop_copies, rows that repeat the kept id and groups without an id also leave one
    row, the smallest by all columns. Only kept rows of groups with copies are shuffled for
    that, after tasks have reduced their own; columns must have an order.
    """
    kept = _kept(docs, doc_id, text)
    several = kept.where("group_size > 1").groupBy("text_sha256").agg(F.min("__row").alias("__row"))
    return kept.where("group_size = 1").select("__row.*").union(several.select("__row.*"))
