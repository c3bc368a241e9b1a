"""Exact copies, repeated windows and near copies."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import WORDS, documents, least_linked, odd, shingles, small

from shelfcast.llm import exact, jaccard, stages, substrings
from shelfcast.llm.components import components
from shelfcast.llm.words import Words


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_copies_of_odd_rows(spark):
    docs = odd(spark)
    rows = exact.mark_copies(docs).collect()
    assert len(rows) == docs.count()
    groups = {}
    for r in docs.collect():
        groups.setdefault(_norm(r.text), []).append(r.doc_id)
    for r in rows:
        ids = groups[_norm(r.text)]
        least = min((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(ids), r.doc_id == least)
        assert r.text_sha256 == hashlib.sha256(_norm(r.text).encode()).hexdigest()
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns and left.where("doc_id = 4").count() == 2
    assert exact.mark_copies(docs.limit(0)).count() == 0


def _removed(docs, window):
    """id -> (words, kept words), by looking at every window in order of id."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for j in range(len(words) - window + 1):
            run = tuple(words[j:j + window])
            if run in seen:
                gone[j:j + window] = [True] * window
            seen.add(run)
        out[i] = (len(words), [w for w, g in zip(words, gone) if not g])
    return out


def _check_removed(docs, window=20):
    expected = _removed([(r.doc_id, r.text) for r in docs.collect()], window)
    rows = substrings.remove_repeats(docs, window).collect()
    assert len(rows) == len(expected)
    for r in rows:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_text) == (n, n - len(kept), " ".join(kept))
        assert sum(s.end - s.start for s in r.removed_spans) == r.n_removed


def test_repeats_of_a_table(spark):
    _check_removed(small(spark))


@pytest.mark.parametrize("hot", [1, 2000])
def test_repeats_in_shifting_contexts(spark, hot, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "HELD", 7)
    line = " ".join(f"w{i}" for i in range(24))
    turn = " ".join("ab"[i % 2] for i in range(50))
    rows = [(i, f"before{i} {line} after{i % 3} end", "en", "s") for i in range(12)]
    rows += [(20, f"{line} {line}", "en", "s"), (21, turn, "en", "s"), (22, f"x {turn} y", "en", "s"),
             (23, " ".join(line.split()[:19]), "en", "s"), (24, " ".join(line.split()[3:23]), "en", "s")]
    _check_removed(documents(spark, rows).repartition(3))


def test_repeats_of_odd_rows(spark):
    docs = odd(spark)
    rows = substrings.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0 and by_id[1].kept_text == ""
    assert by_id[6].n_words == 60_000 and by_id[6].n_removed == 0
    text = " ".join(f"w{i}" for i in range(30))
    twice = documents(spark, [(1, text, None, None), (1, text, None, None), (None, text, None, None), (2, text, None, None)])
    found = sorted(
        ((r.doc_id if r.doc_id is not None else -1), r.n_removed) for r in substrings.remove_repeats(twice).collect()
    )
    assert found == [(-1, 0), (1, 30), (1, 30), (2, 30)]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_automaton_finds_the_earliest_occurrence():
    automaton = substrings.Automaton()
    passages = ["a b c d e".split(), "x b c d y".split(), "c d e c d e".split()]
    assert automaton.matches(passages[0], 2) == []
    for n, p in enumerate(passages):
        automaton.add(p, n)
    assert automaton.matches("q b c d e".split(), 3) == [(1, (0, 4)), (2, (0, 5))]
    assert automaton.matches("d y c d e c".split(), 2) == [(0, (1, 5)), (2, (0, 4)), (3, (0, 5)), (4, (2, 4))]


def test_words_are_runs_of_other_than_ascii_space():
    texts = ["  Ab c \x0b d", "", "\x1c e\n"]
    words = Words(texts, lower=True)
    assert [words.data[s:e].decode() for s, e in zip(words.starts, words.ends)] == ["Ab c", "d", "\x1c", "e"]
    assert words.first.tolist() == [0, 2, 2, 4]
    assert (Words(["aB x"], lower=True).hashes == Words(["Ab X"], lower=True).hashes).all()
    assert (Words(["aB x"]).hashes != Words(["Ab X"]).hashes).all()


def _family(spark):
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for j in range(i % 5):
            words[(i * 37 + j * 29) % 150] = f"edit{i}x{j}"
        rows.append((i, " ".join(words), "en", "s"))
    rows += [(100 + i, " ".join(f"z{j}" for j in range(i, i + 100)), "en", "s") for i in range(0, 40, 4)]
    rows += [(200 + i, f"short text {i % 2}", "en", "s") for i in range(4)] + [(300, "Short", "en", "s"), (301, "sHORT", "en", "s")]
    return documents(spark, rows)


@pytest.mark.parametrize("size,top", [(3, 90), (5, 80)])
def test_groups_of_near_copies(spark, size, top):
    for docs in (_family(spark).repartition(3), small(spark)):
        pairs = [(r.doc_id, r.text) for r in docs.collect()]
        expected, text = least_linked(pairs, size, top), dict(pairs)
        rows = jaccard.similar_groups(docs, size, top, 100).collect()
        assert len(rows) == len(pairs)
        for r in rows:
            assert (r.component_id, r.n_shingles) == (expected[r.doc_id], len(shingles(text[r.doc_id], size)))
        kept = jaccard.drop_similar(docs, size, top, 100)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_groups_of_odd_rows(spark):
    docs = odd(spark)
    rows = jaccard.similar_groups(docs).collect()
    assert len(rows) == docs.count()
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None), (None, 1, None), (4, 1, 4), (5, 1, 4), (8, 1, 8)} <= found
    assert jaccard.similar_groups(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (3, 2)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_of_equal_texts(spark):
    once, twice, none = "A text of its own.", "One text, twice.", "Nothing tells these apart."
    docs = documents(spark, [
        (1, once, "en", "a"), (4, twice, "en", "b"), (4, twice, "en", "b"), (4, twice.replace(" ", "  "), "en", "b"), (5, twice, "fr", "b"),
        (None, none, "en", "a"), (None, none, "en", "a"), (None, none, "fr", "c"), (None, once, "en", "a"),
    ])
    left = stages.drop_exact_copies(spark, docs, None)
    assert left.columns == docs.columns
    rows = [(r.doc_id, _norm(r.text), r.lang) for r in left.collect()]
    assert sorted((r[0] or 0, *r[1:]) for r in rows) == [(0, none, "en"), (1, once, "en"), (4, twice, "en")]
    assert stages.drop_exact_copies(spark, docs.limit(0), None).count() == 0


def test_one_row_of_each_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(120)]
    near = [" ".join(words[:60] + [f"edit{n}"] + words[61:]) for n in range(3)]
    lone = [" ".join(f"z{i}" for i in range(120)), " ".join(f"z{i}" for i in range(119)) + " end"]
    docs = documents(spark, [
        (7, near[0], "en", "a"), (7, near[0], "en", "a"), (7, near[1], "en", "a"), (9, near[2], "en", "a"), (9, near[2], "en", "a"),
        (None, lone[0], "en", "a"), (None, lone[1], "en", "a"), (None, lone[0], "en", "a"), (20, "quite another text", "en", "a"),
        (21, "", "en", "a"), (22, "", "en", "a"),
    ])
    left = stages.drop_near_copies(spark, docs, None)
    assert left.columns == docs.columns
    found = sorted((r.doc_id if r.doc_id is not None else -1) for r in left.collect())
    assert found == [-1, 7, 20, 21, 22]


def test_texts_of_one_id_keep_their_own_flags(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 3)
    hot, cold = (" ".join(f"{x}{i}" for i in range(24)) for x in "hc")
    for shared in (7, None):
        rows = [(i, hot, "en", "s") for i in range(100, 105)] + [(200, cold, "en", "s")]
        docs = documents(spark, rows + [(shared, hot, "en", "s"), (shared, cold, "en", "s")])
        gone = {(r.doc_id, r.kept_text.strip()[:1]): r.n_removed for r in substrings.remove_repeats(docs).collect()}
        assert {k[0]: n for k, n in gone.items() if k[0] != shared} == {i: 24 for i in (100, 101, 102, 103, 104, 200)}
        assert [n for k, n in gone.items() if k[0] == shared] == [0, 0]
