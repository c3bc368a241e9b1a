"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Cosines of random projections of the standardised statistics approximate a Gaussian kernel.
Each task adds up its share of the normal equations, the shares are summed by row, and the
ridge weights are solved from the sum. A part of the labelled rows that the fit has not seen
turns raw scores into probabilities: their raw scores are counted in fixed bins and the bins
made monotone by pooling adjacent violators.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.arrow import apart, batch_of, chunks, code_points, texts_of

STATISTICS = (
    "log_words", "log_chars", "word_length", "lower", "upper", "digits", "blanks", "line_ends",
    "stops", "other_marks", "distinct_words", "top_word", "repeated_word", "distinct_lines",
    "log_line_length", "upper_words",
)
_LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _MARK = range(7)
#: Raw scores are counted in this many bins between these ends for calibration.
BINS, LOW, HIGH = 1500, -0.5, 1.5


@dataclass(frozen=True)
class Model:
    """Everything a score needs; a few arrays whose size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    levels: np.ndarray

    def features(self, stats):
        standard = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(standard @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats):
        return self.features(stats) @ self.weights

    def score(self, stats):
        return np.clip(np.interp(self.raw(stats), self.points, self.levels), 0, 1)


_TABLE = None


def _classes():
    """Character class of every code point."""
    global _TABLE
    if _TABLE is None:
        table = np.full(0x110000, _MARK, dtype=np.uint8)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                table[cp] = _UPPER if c.isupper() else _LOWER
            elif c.isdigit():
                table[cp] = _DIGIT
            elif c.isspace():
                table[cp] = _BLANK
        table[[ord(c) for c in ".,;:?'\"-"]] = _STOP
        table[[10, 13]] = _LINE
        _TABLE = table
    return _TABLE


def statistics(texts):
    """One row of STATISTICS per text; a text without words or letters has zeros there."""
    table = _classes()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = table[code_points("".join(texts))]
    owner = np.repeat(np.arange(len(texts)) * 7, sizes)
    shares = np.bincount(owner + codes, minlength=7 * len(texts)).reshape(len(texts), 7)
    shares = shares / np.maximum(sizes, 1)[:, None]
    rows = np.zeros((len(texts), len(STATISTICS)))
    rows[:, 1] = np.log1p(sizes)
    rows[:, 3:10] = shares[:, [_LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _MARK]]
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if not n:
            continue
        found = {}
        for w in words:
            found[w] = found.get(w, 0) + 1
        lines = [line for line in text.split("\n") if line.strip()]
        again = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
        rows[i, 0] = np.log1p(n)
        rows[i, 2] = sizes[i] / n
        # long texts repeat words as a matter of course: distinct words against a power of n
        rows[i, 10] = np.log(len(found)) / np.log(n) if n > 1 else 1.0
        rows[i, 11] = max(found.values()) / n
        rows[i, 12] = again / n
        rows[i, 13] = len(set(lines)) / len(lines)
        rows[i, 14] = np.log1p(sizes[i] / len(lines))
        rows[i, 15] = sum(map(str.isupper, words)) / n
    return rows


def with_statistics(docs, text="text", out="stats"):
    """All columns of `docs` but the text, with its statistics as an array of doubles.

    A null text counts as empty, whose statistics are zeros. Repeated rows get the same
    statistics; a very long text is one chunk of its own. A column of the name `out` that was
    there before, in whatever case, is replaced.
    """
    return apart(docs, {"text": text}, (out,), lambda rows: _with_statistics(rows, out), without=(text,))


def _with_statistics(docs, out):
    def compute(batches):
        for batch in batches:
            texts = texts_of(batch, "text")
            parts = [statistics(texts[a:b]) for a, b in chunks(texts)]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(rows.ravel())
            )
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, lists], names=[*rest.schema.names, out])

    return docs.mapInArrow(compute, docs.drop("text").schema.add(out, T.ArrayType(T.DoubleType())))


def _matrix(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(STATISTICS))


def _normal_equations(rows, model):
    """Rows of X'X with X'y as the last cell, summed over tasks."""
    schema = pa.schema([("row", pa.int32()), ("cells", pa.list_(pa.float64()))])
    width = len(model.phases) + 1

    def share(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            x = model.features(_matrix(batch.column("stats")))
            total += x.T @ np.hstack([x, batch.column("label").to_numpy(zero_copy_only=False)[:, None]])
        if total.any():
            yield batch_of(schema, list(range(width)), total.tolist())

    def add(group):
        cells = group.column("cells").combine_chunks()
        summed = cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), width + 1).sum(axis=0)
        return pa.Table.from_batches([batch_of(schema, [group.column("row")[0].as_py()], [summed.tolist()])])

    shape = "row int, cells array<double>"
    summed = rows.select("stats", "label").mapInArrow(share, shape).groupBy("row").applyInArrow(add, shape)
    total = np.zeros((width, width + 1))
    for r in summed.collect():  # width rows, a parameter
        total[r.row] = r.cells
    return total


def _pooled(counts, hits):
    """Isotonic means by pooling adjacent violators."""
    blocks = []
    for n, h in zip(counts, hits):
        blocks.append([n, h, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, h2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + h2, blocks[-1][2] + k2]
    return blocks


def _calibration(rows, model):
    """Points and levels of the monotone map from raw score to probability."""
    schema = pa.schema([("bin", pa.int32()), ("label", pa.float64())])

    def place(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column("stats")))
            bins = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield batch_of(schema, bins, batch.column("label"))

    counted = rows.select("stats", "label").mapInArrow(place, "bin int, label double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")
    )
    found = sorted(counted.collect())  # at most BINS rows
    if not found:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    middle = [LOW + (r.bin + 0.5) * (HIGH - LOW) / BINS for r in found]
    points, levels, start = [], [], 0
    for n, hits, size in _pooled([r.n for r in found], [r.hits for r in found]):
        # one row of each class more, so that no level is exactly 0 or 1
        points.append(float(np.mean(middle[start:start + size])))
        levels.append((hits + 1) / (n + 2))
        start += size
    return np.array(points), np.maximum.accumulate(levels)


def fit(rows, calibrate, features=256, width=2.5, penalty=1e-4, seed=7):
    """A Model from rows with `stats` and `label` (0..1); rows with a null in either are left out.

    `calibrate` is a boolean column of `rows`: those rows calibrate, the others fit. Without
    any row the model scores every text 0.5.
    """
    usable = rows.where("stats is not null and label is not null").withColumn("__later", F.coalesce(calibrate, F.lit(False)))
    early = usable.where("not __later")
    cells = [F.col("stats")[i] for i in range(len(STATISTICS))]
    moments = early.agg(
        F.count(F.lit(1)), *[F.avg(c) for c in cells], *[F.stddev_pop(c) for c in cells]
    ).first()
    known, k = moments[0], len(STATISTICS)
    random = np.random.default_rng(seed)
    directions = random.normal(size=(k, features)) / width
    phases = random.uniform(0, 2 * np.pi, features)
    if not known:
        return Model(np.zeros(k), np.ones(k), directions, phases, np.zeros(features + 1),
                     np.array([0.0]), np.array([0.5]))
    mean, deviation = np.array(moments[1:k + 1]), np.array(moments[k + 1:])
    scale = np.where(deviation < 1e-9, 1.0, deviation)
    bare = Model(mean, scale, directions, phases, None, None, None)
    total = _normal_equations(early, bare)
    ridge = np.eye(features + 1) * penalty * known
    ridge[-1, -1] = 0
    weights = np.linalg.lstsq(total[:, :-1] + ridge, total[:, -1], rcond=None)[0]
    fitted = Model(mean, scale, directions, phases, weights, None, None)
    points, levels = _calibration(usable.where("__later"), fitted)
    return Model(mean, scale, directions, phases, weights, points, levels)


def score(rows, model, threshold=0.3):
    """All columns of `rows` but `stats`, with score (0..1) and predicted (score >= threshold)."""
    added = ("score", "predicted")
    return apart(rows, {"stats": "stats"}, added, lambda own: _scored(own, model, threshold), without=("stats",))


def _scored(rows, model, threshold):
    def judge(batches):
        for batch in batches:
            scores = model.score(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            rest = batch.drop_columns(["stats"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(scores, pa.float64())], names=[*rest.schema.names, "score"]
            )

    judged = rows.mapInArrow(judge, rows.drop("stats").schema.add("score", "double"))
    return judged.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
