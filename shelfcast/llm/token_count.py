"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A text is cut into words by the vocabulary's pattern; a word starts as its bytes, and the
adjacent pair of lowest rank (the leftmost of several) is merged until no pair has a rank.
The count is the symbols at the start minus the merges; no identifiers are made up. Words
recur, so each task keeps the counts of words it has seen, up to a fixed number of them.
"""

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import functions as F

from shelfcast.llm.arrow import apart, texts_of

# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words whose counts a task keeps, and the length up to which a word is worth keeping.
KEPT_WORDS, KEPT_LENGTH = 1_000_000, 48


def byte_symbols():
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PairMerger:
    """Counts of one byte-level vocabulary file (its JSON form)."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        vocab, merges = stated["model"]["vocab"], stated["model"]["merges"]
        self.start = [vocab[c] for _, c in sorted(byte_symbols().items())]
        self.wide = max(vocab.values()).bit_length()
        self.pairs = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            key = vocab[left] << self.wide | vocab[right]
            self.pairs.setdefault(key, rank << self.wide | vocab[left + right])
        special = sorted((t["content"] for t in stated["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(WORDS)
        self.seen = _Seen(self.merged)

    def merged(self, word):
        """Tokens of one word."""
        symbols = [self.start[b] for b in word.encode("utf-8", "surrogatepass")]
        size, wide, pairs = len(symbols), self.wide, self.pairs
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            found = pairs.get(symbols[i] << wide | symbols[i + 1])
            if found is not None:
                heap.append((found >> wide) << 32 | i)
        heapify(heap)
        left_over, mask = size, (1 << wide) - 1
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= size:
                continue
            found = pairs.get(symbols[i] << wide | symbols[j])
            if found is None or found >> wide != top >> 32:
                continue  # the pair at this place has changed since it was pushed
            symbols[i], symbols[j] = found & mask, -1
            k = after[i] = after[j]
            left_over -= 1
            if k < size:
                before[k] = i
                found = pairs.get(symbols[i] << wide | symbols[k])
                if found is not None:
                    heappush(heap, (found >> wide) << 32 | i)
            h = before[i]
            if h >= 0:
                found = pairs.get(symbols[h] << wide | symbols[i])
                if found is not None:
                    heappush(heap, (found >> wide) << 32 | h)
        return left_over

    def count(self, text):
        """Tokens of a text; each special string inside it is one token."""
        total, start, of = 0, 0, self.seen.__getitem__
        if self.special is not None:
            for match in self.special.finditer(text):
                total += 1 + sum(map(of, self.words.findall(text, start, match.start())))
                start = match.end()
        return total + sum(map(of, self.words.findall(text, start)))


class _Seen(dict):
    """Counts by word, worked out when first asked for; emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        found = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


@lru_cache(maxsize=1)
def _merger(path):
    return PairMerger(path)


def local_name(spark, path):
    """Ships a vocabulary file to every executor; the name to find it by there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def count_tokens(docs, vocabulary, limit=512, text="text"):
    """All columns of `docs` with n_bytes, n_tokens and over_limit (n_tokens > limit).

    `vocabulary` is the path of a byte-level vocabulary in JSON form; Spark ships the file to
    the executors. A null or empty text has no bytes and no tokens. Texts are counted whole,
    whatever their length, and repeated rows one by one. Columns of the result's names that
    were there, in whatever case, are replaced.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    name = local_name(docs.sparkSession, vocabulary)
    return apart(docs, {"text": text}, added, lambda rows: _counted(rows, name, limit))


def _counted(docs, name, limit):

    def count(batches):
        merger = _merger(SparkFiles.get(name))
        for batch in batches:
            counts = [merger.count(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, "n_tokens"]
            )

    plain = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = plain.mapInArrow(count, plain.select("*").schema.add("n_tokens", "long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
