"""Quality rules: counts of words, symbols and repeats, and compression bands.

How well zstandard compresses a text tells its repetition: prose of a given length falls into
a narrow band of ratios (bytes before to bytes after). Above the band lies text that says the
same again and again, below it key mashing, encoded data and the like. As short texts cannot
compress well, every length has a band of its own. The whole text and each chunk of fixed size
(the last one is judged by its own length) are measured; a text fails where its whole ratio
leaves the band, or where the chunks that leave theirs hold more than a given share of it.

A null text counts as empty: no words, ratio 1, and it fails the base rules as every text below
the least number of words does. Very long texts are read whole; they are compressed in chunks
and as one stream, and their words become one number each. Repeated rows are judged alike, one
by one; there are no ties to break. Columns of the result's names that were there before are
replaced, all others are carried along. Nothing is shuffled, so hot sources or groups of copies
cost what other rows cost.
"""

import re

import numpy as np
import pyarrow as pa
import zstandard

from shelfcast.llm.arrow import batch_of, carried, texts_of, unpacked
from pyspark.sql import functions as F

#: (bytes from, least ratio, largest ratio) at zstandard's level 3; below the first band all pass.
BANDS = (
    (64, 0.6, 2.0), (128, 0.9, 2.6), (256, 1.1, 3.0), (512, 1.25, 3.4), (1024, 1.4, 3.8),
    (4096, 1.6, 4.4), (16384, 1.7, 5.0), (65536, 1.8, 5.6),
)
CHUNK_BYTES = 4096
#: Percent of a text's bytes that may lie in chunks outside their band.
CHUNK_PERCENT = 20
MIN_WORDS, REPEAT_PERCENT = 50, 50
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_SYMBOL = bytes(b for b in range(256) if b not in b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, n_chunks long, bad_chunk_bytes long, in_band boolean, base_failed boolean, kept boolean"
)
ADDED = tuple(part.split()[0] for part in SHAPE.split(", "))


def repeated_words(words, size=3):
    """Words that lie in a window of `size` words found twice or more, the first included."""
    if len(words) <= size:
        return 0
    number = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # windows of two words get dense numbers first, then those of three, so keys stay below 2^63
    key = ids[: len(words) - size + 1]
    for i in range(1, size):
        key = np.unique(key * len(number) + ids[i:i + len(key)], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(size):
        covered[i:i + len(key)] |= again
    return int(covered.sum())


def repeated_lines(text):
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def base_counts(text, data):
    words = _WORD.findall(text)
    symbols = len(data.translate(None, _NOT_SYMBOL))
    return len(words), sum(map(len, words)), symbols, repeated_lines(text), repeated_words(words)


class Bands:
    """Compression ratios and the band that a length has to meet."""

    def __init__(self, bands, level=3):
        self.bands = sorted(bands, reverse=True)
        self.compressor = zstandard.ZstdCompressor(level=level)

    def ratio(self, data):
        return len(data) / len(self.compressor.compress(data)) if data else 1.0

    def meets(self, size, ratio):
        for least_size, low, high in self.bands:
            if size >= least_size:
                return low <= ratio <= high
        return True

    def bad_bytes(self, data, chunk_bytes):
        """Bytes in chunks outside the band of their length."""
        view, bad = memoryview(data), 0
        for at in range(0, len(data), chunk_bytes):
            chunk = view[at:at + chunk_bytes]
            if not self.meets(len(chunk), self.ratio(chunk)):
                bad += len(chunk)
        return bad


def judge(docs, text="text", bands=BANDS, chunk_bytes=CHUNK_BYTES, chunk_percent=CHUNK_PERCENT,
          min_words=MIN_WORDS, repeat_percent=REPEAT_PERCENT):
    """All columns of `docs` with the counts, ratio, n_chunks, bad_chunk_bytes, in_band, base_failed, kept.

    `in_band` is the verdict of the compression bands alone; `kept` asks for it and for the base
    rules (enough words, not too many of them in repeated windows).
    """
    frame = carried(docs, text=F.col(text))

    def run(batches):
        measure = Bands(bands)
        for batch in batches:
            rows = []
            for value in texts_of(batch):
                data = value.encode("utf-8", "surrogatepass")
                counts = base_counts(value, data)
                ratio, size = measure.ratio(data), len(data)
                bad = measure.bad_bytes(data, chunk_bytes)
                in_band = measure.meets(size, ratio) and 100 * bad <= chunk_percent * size
                failed = counts[0] < min_words or 100 * counts[-1] > repeat_percent * counts[0]
                rows.append((*counts, ratio, -(-size // chunk_bytes), bad, in_band, failed, in_band and not failed))
            made = zip(*rows) if rows else [[] for _ in ADDED]
            schema = pa.schema([batch.schema.field("row"), *_ARROW])
            yield batch_of(schema, batch.column("row"), *map(list, made))

    schema = frame.select("row").schema
    for part in SHAPE.split(", "):
        schema = schema.add(*part.split())
    return unpacked(frame.mapInArrow(run, schema), docs.columns, ADDED)


_KINDS = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
_ARROW = [pa.field(n, _KINDS[k]) for n, k in (part.split() for part in SHAPE.split(", "))]
