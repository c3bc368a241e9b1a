"""Removing repeated word windows with suffix automata over shards of the corpus.

The reference is the corpus itself, so its automata are too large to send whole to every
task. They are cut into shards such that equal windows always meet: a window belongs to the
shard of its smallest hash of a few consecutive words (its anchor), which depends on the
window's words alone. Consecutive windows with the same anchor travel as one segment.

1. Anchors are counted; a window whose anchor occurs once occurs once.
2. Documents that hold repeated anchors meet the list of them and send out the segments there.
3. A shard streams its segments in the order (doc_id, start) through a suffix automaton over
   words that it extends as it goes. Where the matching statistics reach the window's length,
   the window also starts earlier. Equal segments are streamed once, the later ones being
   repeats as a whole; the first step of that is done by each task before the shuffle.
4. Documents meet the windows found, and words covered by one are removed.

Anchors that occur very often (a line that a third of all documents hold, each in another
context) are split further: their windows go one by one, each to a shard of its own words.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.arrow import apart, batch_of, chunks, texts_of
from shelfcast.llm.words import Words

#: Words of an anchor, and occurrences from which an anchor's windows go one by one.
ANCHOR_WORDS, HOT = 6, 2000
_SMALLEST = -(2**63)
#: Segments that a task holds back to find equal ones before they are shuffled.
HELD = 100_000
_SEGMENT = pa.schema([
    ("shard", pa.int64()), ("words", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()),
    ("start", pa.int32()), ("windows", pa.int32()),
])
_FOUND = "doc long, text_key long, start int, windows int"


def _segments(words, window, anchor_words=ANCHOR_WORDS):
    """(first word, windows, anchor hash) of the segments of all texts, in order."""
    none = np.zeros(0, dtype=np.int64)
    grams, _ = words.runs(anchor_words)
    n = len(words.hashes) - window + 1
    if n <= 0:
        return none, none, none
    width = window - anchor_words + 1
    best, have = np.arange(len(grams)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(grams[left] <= grams[right], left, right)
        have += step
    best = best[:n]
    inside = np.flatnonzero(words.owner[:n] == words.owner[window - 1:])
    if not len(inside):
        return none, none, none
    chosen = best[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1] + 1)
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(inside)))
    return inside[at], sizes, grams[chosen[at]].view(np.int64)


class Automaton:
    """Suffix automaton over words that grows by one passage after another.

    Each state knows the passage and the end at which its words first occurred. Passages are
    added in the order of their positions, so that is the earliest occurrence.
    """

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [None]

    def add(self, words, passage):
        last = 0
        for i, w in enumerate(words):
            last = self._extend(last, w, (passage, i + 1))

    def _extend(self, last, w, where):
        nexts, link, length = self.next, self.link, self.length
        if w in nexts[last]:
            q = nexts[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        state = self._state({}, 0, length[last] + 1, where)
        p = last
        while p >= 0 and w not in nexts[p]:
            nexts[p][w] = state
            p = link[p]
        if p >= 0:
            q = nexts[p][w]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return state

    def _state(self, nexts, link, length, where):
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        self.first.append(where)
        return len(self.next) - 1

    def _clone(self, p, w, q):
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def matches(self, words, window):
        """(start, first occurrence) of each window of `words` that the automaton holds."""
        state, size, out = 0, 0, []
        nexts, link, length = self.next, self.link, self.length
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                size = length[state]
            if w in nexts[state]:
                state = nexts[state][w]
                size += 1
            while state and length[link[state]] >= window:
                state = link[state]
                size = length[state]
            if size >= window:
                out.append((i + 1 - window, self.first[state]))
        return out


def _shard_repeats(rows, window):
    """Windows (doc, text_key, start, windows) of one shard that also start earlier.

    `rows` are (words, doc, text_key, start). A window is earlier by (doc, start); windows in
    the same place of two texts under one id do not remove each other.
    """
    places = {}
    for words, doc, key, start in rows:
        places.setdefault(words, []).append((doc, start, key))
    found, ordered = [], []
    for words, held in places.items():
        held.sort()
        first = held[0][:2]
        n = words.count(b" ") + 2 - window
        found += [(doc, key, start, n) for doc, start, key in held if (doc, start) > first]
        ordered.append((first, words, [p for p in held if p[:2] == first]))
    if len(ordered) > 1:
        ordered.sort(key=lambda o: o[:2])
        automaton = Automaton()
        for place, (first, words, held) in enumerate(ordered):
            passage = words.split(b" ")
            for start, (other, end) in automaton.matches(passage, window):
                doc, begin = ordered[other][0]
                if (doc, begin + end - window) < (first[0], first[1] + start):
                    found += [(doc_, key, at + start, 1) for doc_, at, key in held]
            automaton.add(passage, place)
    return found


def _send_out(texts, wanted, docs, keys, window):
    """Segments of the texts at the wanted starts, as (shard, words, doc, text_key, start)."""
    words = Words(texts)
    at, sizes, anchors = _segments(words, window)
    owner = words.owner[at] if len(at) else at
    starts = at - words.first[owner]
    for i in np.flatnonzero([int(s) in wanted[o] for s, o in zip(starts, owner)]):
        o, a, n = int(owner[i]), int(at[i]), int(sizes[i])
        if wanted[o][int(starts[i])]:
            for j in range(n):
                line = words.text(a + j, a + j + window)
                yield hash_of(line), line, docs[o], keys[o], int(starts[i]) + j
        else:
            yield int(anchors[i]), words.text(a, a + n - 1 + window), docs[o], keys[o], int(starts[i])


def hash_of(line):
    """A shard number from the words themselves."""
    import xxhash

    return xxhash.xxh3_64_intdigest(line) - 2**63


def _merged(held, window):
    """Rows of a task after equal segments have met: one of each, the later ones as found."""
    first, rows = {}, []
    for shard, words, doc, key, start in held:
        best = first.get((shard, words))
        if best is None or (doc, start) < best[:2]:
            if best is not None:
                rows.append((best[0], None, *best[:1], best[2], best[1], words.count(b" ") + 2 - window))
            first[(shard, words)] = (doc, start, key)
        elif (doc, start) > best[:2]:
            rows.append((doc, None, doc, key, start, words.count(b" ") + 2 - window))
        else:
            rows.append((shard, words, doc, key, start, 0))
    rows += [(shard, words, doc, key, start, 0) for (shard, words), (doc, start, key) in first.items()]
    return rows


def _number(doc_id):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_SMALLEST))


def _text_key(text):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def repeated_windows(docs, window=20, doc_id="doc_id", text="text"):
    """Runs of windows that also start earlier: (doc, text_key, start, windows).

    Each run is `windows` windows, one word apart, from word `start` on. `doc` is the id (the
    smallest long for null) and `text_key` a hash of the text, for rows that share an id.
    """
    anchor_schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])
    place_schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])

    def count(batches):
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                anchors = _segments(Words(texts[a:b]), window)[2]
                yield batch_of(anchor_schema, *np.unique(anchors, return_counts=True))

    def place(batches):
        for batch in batches:
            texts, ids, keys = texts_of(batch), batch.column("doc").to_numpy(), batch.column("text_key").to_numpy()
            for a, b in chunks(texts):
                words = Words(texts[a:b])
                at, _, anchors = _segments(words, window)
                owner = words.owner[at] if len(at) else at
                starts = (at - words.first[owner]).astype(np.int32)
                yield batch_of(place_schema, anchors, ids[a:b][owner], keys[a:b][owner], starts)

    def send(batches):
        held = []
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc").to_pylist()
            keys = batch.column("text_key").to_pylist()
            wanted = [{w["start"]: w["hot"] for w in row} for row in batch.column("wanted").to_pylist()]
            for a, b in chunks(texts):
                for row in _send_out(texts[a:b], wanted[a:b], ids[a:b], keys[a:b], window):
                    held.append(row)
                    if len(held) >= HELD:
                        yield batch_of(_SEGMENT, *map(list, zip(*_merged(held, window))))
                        held = []
        if held:
            yield batch_of(_SEGMENT, *map(list, zip(*_merged(held, window))))

    found_schema = pa.schema([
        ("doc", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()),
    ])

    def match(batches):
        shard, rows = None, []
        for batch in batches:
            found = []
            for number, words, doc, key, start, windows in zip(*(c.to_pylist() for c in batch.columns)):
                if words is None:
                    found.append((doc, key, start, windows))
                    continue
                if number != shard:
                    found += _shard_repeats(rows, window) if len(rows) > 1 else []
                    shard, rows = number, []
                rows.append((words, doc, key, start))
            if found:
                yield batch_of(found_schema, *map(list, zip(*found)))
        found = _shard_repeats(rows, window) if len(rows) > 1 else []
        if found:
            yield batch_of(found_schema, *map(list, zip(*found)))

    light = docs.select(_number(doc_id).alias("doc"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    repeated = (
        light.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
        .where("n > 1").select(F.col("anchor").alias("of"), (F.col("n") > HOT).alias("hot"))
    )
    places = light.mapInArrow(place, "anchor long, doc long, key long, start int")
    # rows that repeat an id and a text have the same starts, each of them once in the set
    wanted = (
        places.join(repeated, F.col("anchor") == F.col("of")).groupBy(F.col("doc").alias("__in_doc"), F.col("key").alias("__in_text"))
        .agg(F.collect_set(F.struct("start", "hot")).alias("__wanted"))
    )
    # joined by the same rows and key as in remove_repeats, so that one exchange serves both
    asked = docs.join(wanted, (_number(doc_id) == F.col("__in_doc")) & (_text_key(text) == F.col("__in_text"))).select(
        F.col("__in_doc").alias("doc"), F.col("__in_text").alias("text_key"), F.col(text).alias("text"),
        F.col("__wanted").alias("wanted"),
    )
    sent = asked.mapInArrow(
        send, "shard long, words binary, doc long, text_key long, start int, windows int"
    )
    dealt = sent.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(match, _FOUND)


def _kept(text, runs, window):
    """(words, removed, spans, kept text) of one text; runs are (start, windows)."""
    words = Words([text])
    n = len(words.starts)
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, windows in runs:
        edges[start] += 1
        edges[start + windows - 1 + window] -= 1
    gone = np.cumsum(edges[:n]) > 0
    kept = b" ".join(
        words.data[s:e] for s, e, g in zip(words.starts.tolist(), words.ends.tolist(), gone.tolist()) if not g
    )
    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    spans = [{"start": int(a), "end": int(b)} for a, b in zip(turns[0::2], turns[1::2])]
    return n, int(gone.sum()), spans, kept.decode("utf-8", "surrogatepass")


def remove_repeats(docs, window=20, doc_id="doc_id", text="text"):
    """All columns of `docs` with n_words, n_removed, removed_spans and kept_text.

    Words are runs other than ASCII white space, unchanged. A word goes if a window of
    `window` consecutive words of its document covers it whose words also start earlier: in a
    document with a smaller id, or earlier in the same one; windows are judged on the input.
    `removed_spans` are the maximal runs removed, as word numbers (end exclusive), and
    `kept_text` the other words joined by one space.

    A null text has no words. A null id counts as smaller than any other. Rows that repeat an
    id and a text get the same result and do not remove each other's words; texts that differ
    under one id are judged alone, with the same rank. Ids must fit a long. Columns of the
    result's names that were there before, in whatever case, are replaced.
    """
    added = ("n_words", "n_removed", "removed_spans", "kept_text")
    own = {"doc_id": doc_id, "text": text}
    return apart(docs, own, added, lambda rows: _without_repeats(rows, window))


def _without_repeats(rows, window, doc_id="doc_id", text="text"):
    kept = rows.columns
    runs = (
        repeated_windows(rows, window, doc_id, text).groupBy(F.col("doc").alias("__doc"), F.col("text_key").alias("__text"))
        .agg(F.collect_set(F.struct("start", "windows")).alias("__runs"))
    )
    same = (_number(doc_id) == F.col("__doc")) & (_text_key(text) == F.col("__text"))
    joined = rows.join(runs, same, "left").select(*kept, F.col("__runs").alias("__own"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    shape = (
        rows.select("*").schema.add("n_words", "long").add("n_removed", "long")
        .add("removed_spans", span).add("kept_text", "string")
    )
    out = pa.schema([
        ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("removed_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept_text", pa.string()),
    ])

    def clean(batches):
        for batch in batches:
            texts, own = texts_of(batch, text), batch.column("__own").to_pylist()
            done = [_kept(t, [tuple(r.values()) for r in runs or []], window) for t, runs in zip(texts, own)]
            rest = batch.drop_columns(["__own"])
            made = batch_of(out, *(map(list, zip(*done)) if done else [[]] * 4))
            yield pa.RecordBatch.from_arrays([*rest.columns, *made.columns], names=[*rest.schema.names, *out.names])

    return joined.mapInArrow(clean, shape)
