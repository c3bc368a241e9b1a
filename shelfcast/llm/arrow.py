"""Small helpers for functions that Spark runs over Arrow batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Characters of text that are turned into arrays at a time.
CHUNK_CHARS = 1_500_000


def chunks(texts, most_rows=512, most_chars=CHUNK_CHARS):
    """Slices of `texts` with a bounded number of rows and characters (one text at least)."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        chars += len(text)
        if i + 1 - start >= most_rows or chars >= most_chars:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch, name="text"):
    """The column as Python strings, null as the empty string."""
    return [t or "" for t in batch.column(name).to_pylist()]


def batch_of(schema, *columns):
    """A record batch of the given pyarrow schema."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=field.type)
        for c, field in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def code_points(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def id_remainder(column, divisor):
    """crc32 of the id written as text, modulo `divisor`; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def quoted(name):
    return F.col("`" + name.replace("`", "``") + "`")


def carried(frame, **inner):
    """The frame's columns as one struct `row`, next to inner columns that cannot clash with them."""
    return frame.select(F.struct(*map(quoted, frame.columns)).alias("row"), *[c.alias(n) for n, c in inner.items()])


def unpacked(frame, columns, added, without=()):
    """The carried columns again, with `added` (name or {name: column}) after them.

    Carried columns of an added name, in whatever case, are replaced; those in `without` go.
    """
    added = added if isinstance(added, dict) else {n: F.col(n) for n in added}
    gone = {n.lower() for n in (*added, *without)}
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in gone]
    return frame.select(*kept, *[c.alias(n) for n, c in added.items()])


def apart(frame, own, added, run, without=()):
    """The frame's columns and `added` ones, made by `run` from a frame in which no name can clash.

    `run` gets the columns `own` ({name there: the caller's name}) and all others in one struct
    `carried`, which it hands on. Columns of an added name, in whatever case, are replaced.
    """
    names = {c.lower(): n for n, c in own.items()}
    rest = [c for c in frame.columns if c.lower() not in names]
    packed = [F.struct(*map(quoted, rest)).alias("carried")] if rest else []
    made = run(frame.select(*[quoted(c).alias(n) for n, c in own.items()], *packed))
    gone = {n.lower() for n in (*added, *without)}
    kept = [
        (F.col(names[c.lower()]) if c.lower() in names else F.col("carried").getField(c)).alias(c)
        for c in frame.columns if c.lower() not in gone
    ]
    return made.select(*kept, *added)
