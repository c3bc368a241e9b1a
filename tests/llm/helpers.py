"""Small frames for the tests of the corpus operators."""

import re

from shelfcast.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = vocabulary()


def documents(spark, rows):
    """Documents from (doc_id, text, lang, source) with extra columns that clash with results."""
    shape = "doc_id long, text string, lang string, source string, score string, block string, kept int, n int"
    return spark.createDataFrame([(*r, "mine", "mine", 7, 8) for r in rows], shape)


def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, and one long text."""
    long_text = " ".join(f"word{i % 977} other{i}" for i in range(30_000))
    return documents(spark, [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", ""), (None, "no id here", "en", "a"),
        (None, None, None, None), (4, "One text, twice.", "en", "b"), (4, "One text, twice.", "en", "b"),
        (5, "One  text,\ntwice.", "fr", "b"), (6, long_text, "en", "a"), (7, "!!! 123", "en", "c"),
        (8, "x", "fr", "c"),
    ])


def small(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def shingles(text, size):
    words = WORDS.findall((text or "").translate(UPPER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def least_linked(docs, size, top):
    """doc_id -> smallest id reachable by links, by comparing all pairs; docs are (id, text)."""
    sets = [(i, shingles(t, size)) for i, t in sorted(docs)]
    found = {i: i for i, _ in sets}

    def root(i):
        while found[i] != i:
            i = found[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and 100 * len(a & b) >= top * len(a | b):
                x, y = sorted((root(i), root(j)))
                found[y] = x
    return {i: root(i) for i, _ in sets}


def check_pieces(pieces, ids, window=1024):
    """Every id of every document (in order of start) lies in one piece; sequences are gapless."""
    import zlib

    import numpy as np

    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at, whole = 0, np.array(ids[doc], dtype="<u4")
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(whole)
            assert p.ids_crc32 == zlib.crc32(whole[at:at + p.length].tobytes())
            at += p.length
        assert at == len(whole)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= window
        padding += window - at if at & (at - 1) else 0
    return padding
