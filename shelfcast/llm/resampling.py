"""Importance resampling towards a target distribution, drawn by a distributed quickselect.

Features of a text are its runs of one to `size` words, hashed into buckets. The buckets of all
documents and of all target texts are counted; the smoothed log ratio of a bucket is its gain,
and the gains are one array of as many numbers as there are buckets, which every task holds. A
document's weight is the mean gain of its features. With a Gumbel variable from a hash of the
id added, the k highest scores are a draw without replacement in proportion to the weights.

The k-th highest score is found without sorting: keys (score, id, place in the written table)
are unique, a pass counts the rows below, at and above some random pivot keys exactly and picks
the next pivots at random between them, and the range narrows until a pivot is the k-th key.
Passes grow with the logarithm of the rows. Only winners are sorted, over ranges of keys; their
ranks are places within a range plus the rows of the ranges before.

A null text counts as empty: no features, weight 0. A null id is hashed as the empty text and
loses ties. Rows that repeat an id are documents of their own; where score and id agree, the
row written first wins. Very long texts are read whole (two bytes a word are written). Where
either table is empty its counts are 0. Columns of the result's names that were there before
are replaced, all others are carried along.
"""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.arrow import batch_of, carried, quoted, texts_of, unpacked
from shelfcast.session import cut_lineage

ADDED = ("n_features", "weight", "score", "rank")
#: Pivot keys of a pass.
PIVOTS = 48
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words whose bucket a task remembers.
_REMEMBERED = 500_000


class _Buckets(dict):
    """Bucket of a run of words, remembered while there is room."""

    def __init__(self, buckets):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, run):
        found = zlib.crc32(run) % self.buckets
        if len(self) < _REMEMBERED:
            self[run] = found
        return found


def _kind(buckets):
    return "<u2" if buckets <= 2**16 else "<u4"


def _features(words, size, known):
    """Buckets of all runs of 1..size consecutive words."""
    found = list(map(known.__getitem__, words))
    for n in range(2, size + 1):
        found += [known[b" ".join(words[i:i + n])] for i in range(len(words) - n + 1)]
    return found


def hashed(frame, size, buckets, text="text"):
    """`row`, the inner columns, n_words and `codes`: the bucket numbers of a text as bytes."""
    rest = [c for c in frame.columns if c != text]
    schema = frame.select(*rest).schema.add("n_words", "long").add("codes", "binary")

    def run(batches):
        known, kind = _Buckets(buckets), _kind(buckets)
        for batch in batches:
            n_words, codes = [], []
            for value in texts_of(batch, text):
                words = _WORD.findall(value.encode("utf-8", "surrogatepass").lower())
                n_words.append(len(words))
                codes.append(np.array(_features(words, size, known), dtype=kind).tobytes())
            fields = [batch.schema.field(c) for c in rest]
            made = pa.schema([*fields, ("n_words", pa.int64()), ("codes", pa.binary())])
            yield batch_of(made, *[batch.column(c) for c in rest], n_words, codes)

    return frame.mapInArrow(run, schema)


def bucket_counts(coded, buckets):
    """Features of all rows in each bucket; tasks send at most one row a bucket."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for codes in batch.column("codes"):
                total += np.bincount(np.frombuffer(codes.as_buffer(), dtype=_kind(buckets)), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = coded.select("codes").mapInArrow(run, "bucket long, n long")
    counts = [0] * buckets
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source, target, buckets):
    """floor(1000 ln of the smoothed ratio of shares) of every bucket."""
    all_source, all_target = sum(source) + buckets, sum(target) + buckets
    ratios = [(t + 1) * all_source / ((s + 1) * all_target) for s, t in zip(source, target)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def weighed(coded, gain):
    """n_features and weight, the floored mean of the gains, instead of the codes."""
    rest = [c for c in coded.columns if c != "codes"]
    schema = coded.select(*rest).schema.add("n_features", "long").add("weight", "long")

    def run(batches):
        for batch in batches:
            n, weight = [], []
            for codes in batch.column("codes"):
                own = gain[np.frombuffer(codes.as_buffer(), dtype=_kind(len(gain)))]
                n.append(len(own))
                weight.append(int(own.sum()) // len(own) if len(own) else 0)
            fields = [batch.schema.field(c) for c in rest]
            made = pa.schema([*fields, ("n_features", pa.int64()), ("weight", pa.int64())])
            yield batch_of(made, *[batch.column(c) for c in rest], n, weight)

    return coded.mapInArrow(run, schema)


def gumbel(doc_id, seed):
    """floor(1000 x a Gumbel variable) from the first 32 bits of SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    first = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    share = (first + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def _literal(row, fields):
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def kth_key(keyed, k, pivots=PIVOTS, seed=7):
    """The k-th smallest (from 1) of the unique struct column `key` whose first field is a number.

    Each pass counts exactly the rows between, at and beyond its pivots and draws, per interval,
    one random key of each of `pivots` hash classes as the next ones. A pass sends the driver one
    row for each interval and class, whatever the size of the table.
    """
    fields, first = keyed.schema["key"].dataType.fields, keyed.schema["key"].dataType.fields[0].name
    draw, low, high, marks, at = random.Random(seed), None, None, [], k
    while True:
        inside = keyed
        if low is not None:
            inside = inside.where((F.col(f"key.{first}") >= low[first]) & (F.col("key") > _literal(low, fields)))
        if high is not None:
            inside = inside.where((F.col(f"key.{first}") <= high[first]) & (F.col("key") < _literal(high, fields)))
        # pivot i has interval 2i + 1, what lies between pivots i - 1 and i has 2i
        place = F.lit(0)
        for mark in marks:
            pivot = _literal(mark, fields)
            place = place + F.when(F.col("key") > pivot, 2).when(F.col("key") < pivot, 0).otherwise(1)
        number = F.xxhash64("key", F.lit(draw.getrandbits(31)))
        parts = inside.select("key", place.alias("spot"), number.alias("h")).groupBy(
            "spot", F.pmod("h", F.lit(pivots)).alias("class")
        ).agg(F.count(F.lit(1)).alias("n"), F.min_by("key", "h").alias("key")).collect()
        sizes, drawn = {}, {}
        for p in parts:
            sizes[p["spot"]] = sizes.get(p["spot"], 0) + p["n"]
            drawn.setdefault(p["spot"], []).append(p["key"])
        for spot in sorted(sizes):
            if at <= sizes[spot]:
                break
            at -= sizes[spot]
        else:
            raise ValueError("fewer keys than k")
        if spot % 2 or sizes[spot] == 1:
            return drawn[spot][0]
        low = marks[spot // 2 - 1] if spot else low
        high = marks[spot // 2] if spot // 2 < len(marks) else high
        marks = sorted(drawn[spot], key=_order)


def _order(row):
    """Sort key of a struct in Spark's order: nulls first."""
    return [(v is not None, v) for v in row]


def ranked(winners):
    """Winners in key order with `rank` from 1: sorted in ranges, each offset by the ranges before."""
    names = [f"key.{f.name}" for f in winners.schema["key"].dataType.fields]
    parts = winners.repartitionByRange(*names).sortWithinPartitions(*names)
    placed = cut_lineage(parts.withColumn("spot", F.monotonically_increasing_id()))
    part, inside = F.shiftright("spot", 33), F.col("spot").bitwiseAND(F.lit(2**33 - 1))
    # one row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    joined = placed.join(sizes, part == F.col("part"))
    return joined.withColumn("rank", F.col("base") + inside + 1).drop("spot", "part", "base")


def resample(docs, target, percent=10, min_words=20, size=1, buckets=10_000, seed=2024,
             doc_id="doc_id", text="text", target_text="text", with_text=True):
    """All rows of `docs` with n_features, weight, score and rank (null: not drawn).

    Of the N documents with at least `min_words` words, N * percent / 100 (floored) are drawn and
    ranked by score, best first. Both tables are counted whole. Without `with_text` the text is
    left out of the result and of the written table.
    """
    kept = docs if with_text else docs.drop(text)
    left = [quoted(c) for c in kept.columns]
    frame = docs.select(F.struct(*left).alias("row"), quoted(doc_id).alias("id"), quoted(text).alias("text"))
    coded = cut_lineage(hashed(frame, size, buckets))
    wanted = hashed(carried(target.select(quoted(target_text)), text=quoted(target_text)).select("text"), size, buckets)
    gain = gains(bucket_counts(coded, buckets), bucket_counts(wanted, buckets), buckets)
    scored = weighed(coded, gain).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).select(
        "row", "n_features", "weight", "score", (F.col("n_words") >= min_words).alias("asked"),
        F.struct(
            (-F.col("score")).alias("score"), F.col("id").isNull().alias("nameless"), "id",
            F.monotonically_increasing_id().alias("place"),
        ).alias("key"),
    )
    scored = cut_lineage(scored)
    asked = scored.where("asked")
    k = asked.count() * percent // 100
    drawn = F.lit(False)
    if k:
        last = kth_key(asked.select("key"), k)
        drawn = F.col("asked") & (F.col("key") <= _literal(last, scored.schema["key"].dataType.fields))
    out = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    if k:
        out = ranked(scored.where(drawn)).unionByName(out)
    return unpacked(out, kept.columns, ADDED)
