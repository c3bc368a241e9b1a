"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

A stripe of the empty prefix counts words, one of a single word counts the words after it, and
so on up to three words. Tasks build stripes over a bounded number of words, send them as
(prefix, next words, counts), and Spark merges them elementwise. Everything comes from these
merged stripes: an entry is the frequency of prefix + next word, the stripe of the empty prefix
has the number of all words, and the largest entry on either side of a phrase tells whether a
longer phrase subsumes it.

Stripes are merged length by length. A phrase cannot be more frequent than the phrases inside
it, so longer stripes are only built where both shorter phrases were frequent. Tasks learn that
from a bit map of fixed size (a hash of each frequent phrase sets one bit); a false bit costs a
needless entry and changes no result. Stripes of frequent prefixes are split into segments by a
hash of the next word, so no task holds the whole counter of a hot prefix.

A null text counts as empty and a null language as `und`; empty texts have no words. Repeated
rows count each time. Very long texts are cut into words slice by slice and counted in windows,
so only their word numbers are held. Ties in score go to the higher frequency, then to the
phrase that is smaller by its UTF-8 bytes; of cuts with the same score the earliest counts. An
empty table gives no rows. Only language and text are read, so other columns cannot clash.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.arrow import quoted, texts_of
from shelfcast.session import cut_lineage

UNKNOWN = "und"
LONGEST = 4
#: Words whose stripes a task builds at a time; word numbers stay below it.
WINDOW_WORDS = 2**21
#: Segments of the stripes of no word, of one word and of more.
SEGMENTS = (1024, 64, 8)
#: Bits of the map of frequent phrases (8 MB).
BITS = 2**26
#: Groups in which the best phrases of a language are found before they meet.
SALTS = 128
_SLICE = 1_000_000
_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")
_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_EDGE = re.compile(rb"[ \t.,;:!?\n-\r]")
STRIPES = "lang string, prefix string, segment int, next array<string>, n array<long>"


class _Numbers(dict):
    """Number of each word of a language, -1 for what ends a piece."""

    def __missing__(self, word):
        self[word] = number = -1 if word[0] in _BREAKS else len(self)
        return number


def _tokens(data):
    """Words and breaks of a text, a slice at a time; slices end where no word does."""
    at = 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            edge = _EDGE.search(data, end)
            end = edge.start() if edge else len(data)
        yield _TOKEN.findall(data, at, min(end, len(data)))
        at = end


class _Window:
    """Words of one language, numbered, until their stripes are built.

    Numbers are given in order of appearance and breaks take one too, so a word's number is
    below the number of tokens read.
    """

    def __init__(self):
        self.numbers, self.parts = _Numbers(), []

    def add(self, data):
        """Takes a text in; returns its number of words and breaks."""
        size = 0
        for tokens in _tokens(data):
            self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens)))
            size += len(tokens)
        self.parts.append(np.array([-1]))
        return size

    def ids(self):
        return np.concatenate([*self.parts, np.full(LONGEST, -1)])

    def words(self):
        known = [(number, word) for word, number in self.numbers.items() if number >= 0]
        return [n for n, _ in known], [w for _, w in known]


def _hashes(lang, words):
    """Spark's xxhash64(lang, word) of every word."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _bits_of(hashes, bits):
    """Bit of a phrase from the hashes of its words, as `_bit` in Spark."""
    total = hashes[0].copy()
    for i, h in enumerate(hashes[1:], 1):
        total ^= (h << np.uint64(i)) | (h >> np.uint64(64 - i))
    return total & np.uint64(bits - 1)


def _bit(lang, words, size, bits):
    total = F.xxhash64(lang, F.get(words, F.lit(0)))
    for i in range(1, size):
        h = F.xxhash64(lang, F.get(words, F.lit(i)))
        turned = F.shiftleft(h, i).bitwiseOR(F.shiftrightunsigned(h, 64 - i))
        total = total.bitwiseXOR(turned)
    return total.bitwiseAND(F.lit(bits - 1).cast("long"))


def _frequent_bits(phrases, size, bits):
    """Bit map of the phrases of `size` words: `bits` / 8 bytes, however many phrases there are."""
    bit = _bit(F.col("lang"), F.split("phrase", " "), size, bits)
    cells = phrases.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63L as int))")).alias("mask")
    ).toArrow()
    found = np.zeros(bits // 64, dtype=np.int64)
    found[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy()
    return found.view(np.uint64)


def _has(found, at):
    return (found[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _stripe_batch(lang, words, hashes, prefix, following, n, segments):
    """Rows of (prefix, segment) from entries in the order of their prefixes.

    `prefix` holds one array of word numbers for each place of the prefix.
    """
    changes = np.zeros(len(following), dtype=bool)
    for column in prefix:
        changes[1:] |= column[1:] != column[:-1]
    segment = (hashes[following] % np.uint64(segments)).astype(np.int64)
    key = np.cumsum(changes) * segments + segment
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(starts, len(order)), pa.int32())
    texts = pa.array(words, pa.binary()).cast(pa.string())
    parts = [texts.take(pa.array(column[order[starts]])) for column in prefix]
    if not parts:
        text = pa.array([""] * len(starts), pa.string())
    else:
        text = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
    lists = [
        pa.ListArray.from_arrays(offsets, v)
        for v in (texts.take(pa.array(following[order])), pa.array(n[order], pa.int64()))
    ]
    named = pa.array([lang] * len(starts), pa.string())
    return pa.RecordBatch.from_arrays(
        [named, text, pa.array(segment[order[starts]], pa.int32()), *lists],
        names=["lang", "prefix", "segment", "next", "n"],
    )


def _counted(columns, known):
    """Distinct rows of word numbers (below `known`), in order, with their counts.

    Numbers are put side by side into one integer; where they do not fit, the leading ones are
    first replaced by the place of their combination among all.
    """
    bits = max(1, (int(known) - 1).bit_length())
    fit = 63 // bits
    if len(columns) > fit:
        packed = _side_by_side(columns[:fit], bits)
        lead = np.unique(packed)
        (place, *rest), n = _counted([np.searchsorted(lead, packed), *columns[fit:]], max(known, len(lead)))
        return [*_apart(lead[place], bits, fit), *rest], n
    key = np.sort(_side_by_side(columns, bits))
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return _apart(key[starts], bits, len(columns)), np.diff(np.append(starts, len(key)))


def _side_by_side(columns, bits):
    key = columns[0]
    for column in columns[1:]:
        key = (key << bits) | column
    return key


def _apart(key, bits, size):
    mask = (1 << bits) - 1
    return [(key >> (bits * i)) & mask for i in range(size - 1, -1, -1)]


def _stripes(lang, window, lengths, found, bits):
    """Stripes of the prefixes of given lengths over a window, a bounded number of starts at a time."""
    ids = window.ids()
    at, words = window.words()
    dense = np.full(max(at, default=-1) + 2, -1, dtype=np.int64)  # breaks took numbers as well
    dense[at] = np.arange(len(at))
    ids = np.where(ids < 0, -1, dense[ids])
    hashes = _hashes(lang, words)
    for low in range(0, len(ids) - LONGEST, WINDOW_WORDS):
        for length in lengths:
            block = ids[low:min(low + WINDOW_WORDS, len(ids) - LONGEST) + length]
            starts = len(block) - length
            columns = [block[i:i + starts] for i in range(length + 1)]
            spots = np.flatnonzero(np.logical_and.reduce([c >= 0 for c in columns]))
            if found is not None:
                for part in (columns[:-1], columns[1:]):
                    spots = spots[_has(found, _bits_of([hashes[c[spots]] for c in part], bits))]
            columns, n = _counted([c[spots] for c in columns], len(words))
            if len(n):
                segments = SEGMENTS[min(length, len(SEGMENTS) - 1)]
                yield _stripe_batch(lang, words, hashes, columns[:-1], columns[-1], n, segments)
            if length == 0:
                # the empty word, which no text has, counts all words
                yield _stripe_batch(lang, [b""], np.zeros(1, np.uint64), [], np.zeros(1, np.int64), n.sum(keepdims=True), 1)


def stripes(docs, lengths, found=None, bits=BITS):
    """Partial stripes of all prefixes of the given lengths; `docs` has lang and text.

    With `found`, the map of frequent phrases of one such length, only where both inner phrases
    may be frequent.
    """

    def run(batches):
        windows, held = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                held += windows.setdefault(lang, _Window()).add(text.encode("utf-8", "surrogatepass").lower())
                if held >= WINDOW_WORDS:
                    for full in windows:
                        yield from _stripes(full, windows[full], lengths, found, bits)
                    windows, held = {}, 0
        for full in windows:
            yield from _stripes(full, windows[full], lengths, found, bits)

    return docs.mapInArrow(run, STRIPES)


def merged(partial, least):
    """(lang, phrase, words, a) of stripe entries with at least `least` occurrences, added up elementwise.

    Segments of stripes meet in one exchange; their entries are then added up where they are.
    """
    met = partial.repartition("lang", "prefix", "segment")
    entries = met.select("lang", "prefix", "segment", F.explode(F.arrays_zip("next", "n")).alias("e"))
    sums = entries.groupBy("lang", "prefix", "segment", F.col("e.next").alias("next")).agg(F.sum("e.n").alias("a"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    words = F.when(F.col("next") == "", 0).when(F.col("prefix") == "", 1).otherwise(F.size(F.split("prefix", " ")) + 1)
    return sums.where((F.col("a") >= least) | (F.col("next") == "")).select(
        "lang", phrase.alias("phrase"), words.alias("words"), "a"
    )


def frequent_phrases(docs, least=30, longest=LONGEST, lang="lang", text="text", bits=BITS):
    """(lang, phrase, words, a) of all phrases of up to `longest` words found `least` times or more.

    The empty phrase of a language has the number of its words. Words and pairs are counted in one
    pass over the texts, each longer length in one more.
    """
    asked = docs.select(F.coalesce(quoted(lang), F.lit(UNKNOWN)).alias("lang"), quoted(text).alias("text"))
    out = cut_lineage(merged(stripes(asked, (0, 1)[:longest]), least))
    newest = out.where("words = 2")
    for length in range(2, longest):
        found = _frequent_bits(newest, length, bits)
        if not found.any():
            break
        newest = cut_lineage(merged(stripes(asked, (length,), found, bits), least))
        out = out.unionByName(newest)
    return out


def scored(phrases, longest=LONGEST, subsumed_percent=80):
    """Candidates (two words or more) that no longer one subsumes: lang, phrase, a, l, r, score."""
    candidates = phrases.where("words > 1")
    cuts = candidates.select("lang", "phrase", F.split("phrase", " ").alias("w"), "words").select(
        "lang", "phrase", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    parts = cuts.select("lang", "phrase", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")),
        F.struct(F.lit(1).alias("side"), F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("part")),
    )).alias("p")).select("lang", "phrase", "k", "p.side", "p.part")
    # hot parts (a common word) lie on this side, which Spark may split: the other has one row a part
    known = phrases.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    lengths = parts.join(known, ["lang", "part"]).select("lang", "phrase", "k", "side", "f")
    own = candidates.select("lang", "phrase", "a")
    # one word less on either side; a longer phrase around these is no more frequent than they are
    around = candidates.where("words > 2").select("a", "lang", F.split("phrase", " ").alias("w"), "words").select(
        "lang", "a", F.explode(F.array(
            F.array_join(F.slice("w", F.lit(1), F.col("words") - 1), " "),
            F.array_join(F.slice("w", F.lit(2), F.col("words") - 1), " "),
        )).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    facts = lengths.unionByName(own, allowMissingColumns=True).unionByName(around, allowMissingColumns=True)
    per_cut = [
        F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"f{k}{side}")
        for k in range(1, longest) for side in (0, 1)
    ]
    whole = facts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *per_cut)

    def score(k):
        parts = F.col(f"f{k}0").cast("decimal(19,0)") + F.col(f"f{k}1").cast("decimal(19,0)")
        value = F.call_function("div", F.col("a").cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)"), parts)
        return F.when(F.col(f"f{k}0").isNotNull(), F.struct(
            value.alias("score"), F.lit(k).alias("k"), F.col(f"f{k}0").alias("l"), F.col(f"f{k}1").alias("r")
        ))

    free = F.coalesce(100 * F.col("longer").cast("decimal(19,0)") < subsumed_percent * F.col("a").cast("decimal(19,0)"),
                      F.lit(True))
    cuts_of = [score(k) for k in range(1, longest)]
    best = F.least(*cuts_of) if len(cuts_of) > 1 else cuts_of[0]
    return whole.where(free).select("lang", "phrase", "a", best.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score")
    )


def mine(docs, least=30, longest=LONGEST, subsumed_percent=80, top=2000, lang="lang", text="text", bits=BITS):
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    `a`, `l` and `r` are the frequencies of the phrase and of the parts at its weakest cut, n the
    number of words of the language.
    """
    phrases = frequent_phrases(docs, least, longest, lang, text, bits)
    found = scored(phrases, longest, subsumed_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = near.where(F.col("rank") <= top).drop("salt").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
