"""Similarity join of documents by the Jaccard index of their word n-grams.

Texts with equal n-gram sets form a class that is compared once. The n-grams of a class are
ordered rare first; two classes can only reach the threshold if they share an n-gram in their
prefixes, at places and sizes that leave enough n-grams for the overlap (length and positional
filter), and if counts of their n-grams in a few hash ranges allow it (suffix filter). What
passes is verified on whole texts, once per pair.

As groups are what is asked for, a pair that is known to be connected needs no check. So a
first round verifies every class against one leader per shared n-gram, and only where classes
that share an n-gram are still apart does a second round go through the remaining pairs. Hence
a large family of near copies costs one check per member, not one per pair, and no link
between groups is missed.

Rare means few occurrences in a count sketch of fixed size over all documents: any order
gives the same result, the sketch only makes it fast.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.arrow import apart, batch_of, chunks, texts_of
from shelfcast.llm.components import components
from shelfcast.llm.words import Words, mixed, powers
from shelfcast.session import cut_lineage

#: Counters of the sketch, in pieces that are added up apart, and hash ranges of the last filter.
COUNTERS, PIECES, RANGES = 2**20, 16, 32
_LIGHT = pa.schema([
    ("row", pa.int64()), ("key", pa.int64()), ("class", pa.int64()), ("second", pa.int64()), ("size", pa.int32()),
    ("piece", pa.int32()), ("counts", pa.binary()),
])


def shingle_sets(texts, size, seed=0):
    """Sorted distinct n-gram hashes of each text.

    A text with fewer words has one n-gram, all its words; without words it has none.
    """
    words = Words(texts, lower=True)
    grams, inside = words.runs(size)
    grams = mixed(grams + np.uint64(seed)) if seed else grams
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            total = np.sum(words.hashes[a:b] * powers(int(b - a)))
            yield mixed(np.array([total + np.uint64(int(b - a) + seed)], dtype=np.uint64) ^ np.uint64(0x5BD1E995))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _class_of(grams):
    """Two 64-bit hashes of a set of n-grams."""
    if not len(grams):
        return 0, 0
    one = int(np.sum(mixed(grams ^ np.uint64(0xA5A5A5A5)))) ^ len(grams)
    two = int(np.sum(mixed(grams + np.uint64(0x1234567))))
    both = mixed(np.array([one & (2**64 - 1), two & (2**64 - 1)], dtype=np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def _light(rows, size, seed):
    """Class and size of every row, and the pieces of each task's count sketch, written once."""

    def read(batches):
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            texts, out = texts_of(batch), []
            for a, b in chunks(texts):
                for grams in shingle_sets(texts[a:b], size, seed):
                    np.add.at(counts, grams % COUNTERS, 1)
                    out.append((*_class_of(grams), len(grams)))
            if out:
                none = [None] * len(out)
                yield batch_of(
                    _LIGHT, batch.column("row"), batch.column("key"), *map(list, zip(*out)), none, none
                )
        width = COUNTERS // PIECES
        for p in range(PIECES):
            piece = counts[p * width:(p + 1) * width]
            if piece.any():
                yield batch_of(_LIGHT, *[[None]] * 5, [p], [zlib.compress(piece.tobytes(), 1)])

    return cut_lineage(rows.mapInArrow(
        read, "row long, key long, class long, second long, size int, piece int, counts binary"
    ))


def _sketch(light):
    """The tasks' sketches added up: COUNTERS numbers."""
    schema = pa.schema([("piece", pa.int32()), ("counts", pa.binary())])

    def add(batches):
        sums = {}
        for batch in batches:
            for p, raw in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist()):
                values = np.frombuffer(zlib.decompress(raw), dtype=np.uint32).astype(np.int64)
                sums[p] = sums.get(p, 0) + values
        for p, values in sums.items():
            yield batch_of(schema, [p], [values.astype("<i8").tobytes()])

    pieces = light.where("piece is not null").select("piece", "counts")
    summed = pieces.repartition(PIECES, "piece").mapInArrow(add, "piece int, counts binary").collect()
    total = np.zeros((PIECES, COUNTERS // PIECES), dtype=np.int64)
    for r in summed:  # one row per piece
        total[r.piece] += np.frombuffer(r.counts, dtype="<i8")
    return np.minimum(total.ravel(), 2**31 - 1).astype(np.int32)


def prefix(grams, often, top, bottom):
    """The n-grams of a set that a partner at the threshold must share one of, rare first."""
    n = len(grams)
    length = n - -(-top * n // bottom) + 1
    if length < n // 4:
        near = np.flatnonzero(often <= np.partition(often, length - 1)[length - 1])
        grams, often = grams[near], often[near]
    return grams[np.lexsort((grams, often))[:length]]


def _entries(rows, sketch, size, seed, top, bottom):
    """(gram, class, spot) of the prefix of every row's set; spot is size * 2^32 + place."""
    schema = pa.schema([("gram", pa.int64()), ("class", pa.int64()), ("spot", pa.int64())])
    shared = rows.sparkSession.sparkContext.broadcast(sketch)  # COUNTERS numbers, whatever the data

    def read(batches):
        common = shared.value
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                found, classes, spots = [], [], []
                for grams in shingle_sets(texts[a:b], size, seed):
                    if not len(grams):
                        continue
                    first = prefix(grams, common[grams % COUNTERS], top, bottom)
                    found.append(first)
                    classes.append(np.full(len(first), _class_of(grams)[0], dtype=np.int64))
                    spots.append((len(grams) << 32) + np.arange(len(first), dtype=np.int64))
                if found:
                    yield batch_of(
                        schema, np.concatenate(found).view(np.int64), np.concatenate(classes), np.concatenate(spots)
                    )

    return rows.select("text").mapInArrow(read, "gram long, class long, spot long")


def _texts(rows, wanted, size, seed):
    """(class, size, ranges, text) of one text of each wanted class, written once.

    `wanted` has (class, rep), the id under which the class is found; of rows that share an
    id only one with the class's text is taken. Such rows meet in one task, so nothing is
    shuffled to find them; where a skewed join is split they may stay twice, which does no harm.
    """
    schema = pa.schema([
        ("class", pa.int64()), ("size", pa.int32()), ("ranges", pa.list_(pa.int32())), ("text", pa.string()),
    ])

    def read(batches):
        seen = set()
        for batch in batches:
            texts, classes = texts_of(batch), batch.column("class").to_pylist()
            out = []
            for a, b in chunks(texts):
                for i, grams in zip(range(a, b), shingle_sets(texts[a:b], size, seed)):
                    if classes[i] not in seen and _class_of(grams)[0] == classes[i]:
                        seen.add(classes[i])
                        ranges = np.bincount((grams >> np.uint64(59)).astype(np.int64), minlength=RANGES)
                        out.append((classes[i], len(grams), ranges.tolist(), texts[i]))
            if out:
                yield batch_of(schema, *map(list, zip(*out)))

    asked = rows.join(wanted, F.col("row").eqNullSafe(F.col("rep")))
    found = asked.select("class", "text").mapInArrow(read, "class long, size int, ranges array<int>, text string")
    return cut_lineage(found)


def _reach(size_a, place_a, size_b, place_b, top, bottom):
    """Whether sizes, and places of a first shared n-gram, leave room for the threshold."""
    return (
        f"{bottom} * least({size_a}, {size_b}) >= {top} * greatest({size_a}, {size_b}) and "
        f"{top + bottom} * least({size_a} - {place_a}, {size_b} - {place_b}) >= {top} * ({size_a} + {size_b})"
    )


def _verified(pairs, texts, size, seed, top, bottom):
    """The pairs (a, b) whose sets reach the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches):
        for batch in batches:
            sets, links = {}, []
            for side in ("a", "b"):
                fresh = {
                    c: t for c, t in zip(batch.column(side).to_pylist(), batch.column(f"text_{side}").to_pylist())
                    if c not in sets
                }
                names, held = list(fresh), list(fresh.values())
                for x, y in chunks(held):
                    sets.update(zip(names[x:y], shingle_sets(held[x:y], size, seed)))
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if bottom * common >= top * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
            if links:
                yield batch_of(schema, *map(list, zip(*links)))

    def side(name):
        return texts.select(
            F.col("class").alias(f"class_{name}"), F.col("size").alias(f"size_{name}"),
            F.col("ranges").alias(f"ranges_{name}"), F.col("text").alias(f"text_{name}"),
        )

    joined = pairs.join(side("a"), F.col("a") == F.col("class_a")).join(side("b"), F.col("b") == F.col("class_b"))
    most = "aggregate(zip_with(ranges_a, ranges_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    room = joined.where(f"{top + bottom} * {most} >= {top} * (size_a + size_b)")
    return room.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _pairs(frame, a, b):
    return frame.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _star_pairs(spots, top, bottom):
    """Every class with one leader for each n-gram it shares: the one with the earliest place."""
    leaders = spots.groupBy(F.col("gram").alias("of")).agg(F.min(F.struct("place", "class", "size")).alias("lead"))
    met = spots.join(leaders, F.col("gram") == F.col("of"))
    fits = _reach("size", "place", "lead.size", "lead.place", top, bottom)
    return _pairs(met.where(f"class <> lead.class and {fits}"), F.col("class"), F.col("lead.class"))


def _open_pairs(spots, known, top, bottom):
    """Pairs that share an n-gram, can reach the threshold and are not yet connected.

    Classes with the same size and place under an n-gram are looked at together first; only
    kinds that can reach each other and hold different components are spelled out.
    """
    part = F.coalesce("component", "class")
    marked = cut_lineage(
        spots.join(known, F.col("class") == F.col("id"), "left").select("gram", "class", "size", "place", part.alias("part"))
    )
    kinds = marked.groupBy("gram", "size", "place").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))

    def named(frame, end):
        return frame.select(*[F.col(c).alias(c + end) for c in frame.columns])

    fits = _reach("size_x", "place_x", "size_y", "place_y", top, bottom)
    mixed_kinds = named(kinds, "_x").join(named(kinds, "_y"), F.expr(
        "gram_x = gram_y and (size_x < size_y or (size_x = size_y and place_x <= place_y)) and "
        f"least(lo_x, lo_y) < greatest(hi_x, hi_y) and {fits}"
    )).select("gram_x", "size_x", "place_x", "size_y", "place_y")
    left = mixed_kinds.join(named(marked, "_a"), F.expr(
        "gram_x = gram_a and size_x = size_a and place_x = place_a"
    )).select("gram_x", "size_y", "place_y", "class_a", "part_a")
    both = left.join(named(marked, "_b"), F.expr(
        "gram_x = gram_b and size_y = size_b and place_y = place_b and part_a <> part_b"
    ))
    return _pairs(both, F.col("class_a"), F.col("class_b"))


def _classes(rows, size):
    """(light, classes, seed): hashes that two different sets share are dropped for others."""
    seed = 0
    while True:
        light = _light(rows, size, seed)
        classes = cut_lineage(
            light.where("piece is null and size > 0").groupBy("class").agg(
                F.min("row").alias("rep"), F.min("second").alias("lo"), F.max("second").alias("hi")
            )
        )
        if classes.where("lo <> hi").isEmpty():
            return light, classes.select("class", "rep"), seed
        seed += 1


def _groups(docs, size, top, bottom, doc_id, text):
    """(row, key, size, least, part) per document: id, text hash, set size, the group's least id and the group.

    `part` is null where a document has no words, as it is in no group.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("row"), F.xxhash64(body).alias("key"), body.alias("text"))
    light, classes, seed = _classes(rows, size)
    entries = _entries(rows, _sketch(light), size, seed, top, bottom)
    shared = (
        entries.groupBy(F.col("gram").alias("of")).agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
        .where("lo < hi").select("of")
    )
    spots = cut_lineage(
        entries.join(shared, F.col("gram") == F.col("of"), "left_semi").distinct()
        .select("gram", "class", F.shiftright("spot", 32).alias("size"), F.expr("spot & 4294967295").alias("place"))
    )
    wanted = spots.select(F.col("class").alias("in_class")).distinct()
    texts = _texts(rows, classes.join(wanted, F.col("class") == F.col("in_class")).select("class", "rep"), size, seed)
    near = cut_lineage(_verified(_star_pairs(spots, top, bottom), texts, size, seed, top, bottom))
    rest = _verified(_open_pairs(spots, components(near), top, bottom), texts, size, seed, top, bottom)
    known = components(near.union(rest))
    grouped = classes.join(known, F.col("class") == F.col("id"), "left").select(
        F.col("class").alias("in_class"), "rep", F.coalesce("component", "class").alias("part")
    )
    least = grouped.groupBy(F.col("part").alias("in_part")).agg(F.min("rep").alias("least"))
    named = grouped.join(least, F.col("part") == F.col("in_part")).select("in_class", "least", "part")
    documents = light.where("piece is null").select("row", "key", "class", "size")
    joined = documents.where("size > 0").join(named, F.col("class") == F.col("in_class"))
    alone = documents.where("size = 0").select("row", "key", "size", F.col("row").alias("least"), F.lit(None).cast("long").alias("part"))
    return joined.select("row", "key", "size", "least", "part").union(alone)


def similar_groups(docs, size=5, top=80, bottom=100, doc_id="doc_id", text="text"):
    """One row per document: doc_id, n_shingles, component_id.

    A document's set holds its distinct runs of `size` words, A-Z lower-cased (all its words
    as one run if it has fewer). Two documents link when their sets' Jaccard index is at
    least top/bottom; component_id is the smallest doc_id reachable by links, its own
    included. Empty sets link with nothing.

    A null text has no words. A null id takes no part in the minimum: it is the component_id
    only of a document that links with no other id. Repeated rows are documents of their own
    with equal sets. Ids must fit a long. Only doc_id and text of `docs` are read.
    """
    return _groups(docs, size, top, bottom, doc_id, text).select(
        F.col("row").alias(doc_id), F.col("size").cast("long").alias("n_shingles"), F.col("least").alias("component_id")
    )


def drop_similar(docs, size=5, top=80, bottom=100, doc_id="doc_id", text="text"):
    """One row of each group of documents that link, however far; columns are unchanged.

    The smallest id stays, and of several texts under it, or of a group without ids, the one with
    the smallest hash. Of rows that repeat the id and text of the one that stays, the smallest by
    all columns stays (columns must have an order). Rows without words are in no group: all stay.
    """
    return apart(docs, {"doc_id": doc_id, "text": text}, (), lambda rows: _one_of_each(rows, size, top, bottom))


def _one_of_each(docs, size, top, bottom, doc_id="doc_id", text="text"):
    grouped = cut_lineage(_groups(docs, size, top, bottom, doc_id, text).where("part is not null").select("row", "key", "part"))
    pair = F.struct(F.col("row").isNull().alias("none"), "row", "key")
    best = grouped.groupBy(F.col("part").alias("in_part")).agg(F.min(pair).alias("best"))
    loses = ~(F.col("row").eqNullSafe(F.col("best.row")) & (F.col("key") == F.col("best.key")))
    later = grouped.join(best, F.col("part") == F.col("in_part")).where(loses).select("row", "key").distinct()
    repeated = grouped.groupBy("row", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row", "key")

    def met(marks, how):
        marks = marks.select(F.col("row").alias("__row"), F.col("key").alias("__key"))
        of_text = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
        return docs.join(marks, F.col(doc_id).cast("long").eqNullSafe(F.col("__row")) & (of_text == F.col("__key")), how)

    several = met(repeated.subtract(later), "inner").groupBy("__row", "__key").agg(
        F.min(F.struct(*docs.columns)).alias("__doc")
    )
    return met(later.union(repeated).distinct(), "left_anti").union(several.select("__doc.*"))
