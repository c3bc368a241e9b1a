"""Packing, exact search, mixing, and url rules."""

import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import VOCABULARY, check_pieces, documents, odd, small
from tokenizers import Tokenizer

from shelfcast.llm import mixing, packing, pivots, url_rules
from shelfcast.llm.queries import PAGE_RULES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def _ids(library, rows):
    return {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [0] for r in rows}


def test_pieces_hold_every_token_once_without_padding(spark, library):
    docs = small(spark)
    pieces = packing.pack(docs, VOCABULARY, shard_bytes=100_000).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) > 1
    assert check_pieces(pieces, _ids(library, docs.collect())) == 0
    own = sorted((p for p in pieces if p.doc_id == 0), key=lambda p: p.start)
    assert [i for p in own for i in p.ids] == library.encode(docs.where("doc_id = 0").first().text).ids + [0]


def test_windows_are_filled_with_the_nearest_documents():
    random = np.random.default_rng(5)
    topics = [random.integers(100 * t, 100 * t + 60, (6, 100)) for t in range(4)]
    ids = [np.append(topics[t][n], 0).astype("<u4") for n in range(6) for t in range(4)]
    pieces = packing.fill_windows(ids, 256)
    by_sequence = {}
    for doc, _, _, sequence, _ in pieces:
        by_sequence.setdefault(sequence, set()).add(doc % 4)
    assert np.mean([len(t) for t in by_sequence.values()]) < 2
    assert sum(p[2] for p in pieces) == sum(map(len, ids))


def test_bm25_scores_by_definition():
    ids = [np.array(x) for x in ([1, 2, 2], [2, 3, 3, 3], [4], [1, 5])]
    index = packing.InvertedIndex(ids, most_common=1.0)
    mean = 10 / 4

    def part(term, doc):
        tf, n = (ids[doc] == term).sum(), sum(term in x for x in ids)
        norm = packing.K1 * (1 - packing.B + packing.B * len(ids[doc]) / mean)
        return math.log(1 + (4 - n + 0.5) / (n + 0.5)) * tf * (packing.K1 + 1) / (tf + norm)

    expected = [part(1, 0) + part(2, 0), part(2, 1), 0, part(1, 3)]
    assert np.allclose(index.scores(np.array([2, 1, 1, 9])), expected)


def test_packing_of_odd_rows(spark, library):
    docs = odd(spark)
    pieces = packing.pack(docs, VOCABULARY, with_ids=False).collect()
    ids = [len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()]
    assert sum(p.length for p in pieces) == sum(ids)
    assert len([p for p in pieces if p.doc_id == 4]) >= 2 and len([p for p in pieces if p.doc_id is None]) >= 2
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, VOCABULARY, window=1000)


def _brute(rows, queries, k):
    out = set()
    for q in queries:
        scored = sorted((-int(np.dot(rows[q], rows[v])), v) for v in rows if v != q)[:k]
        out |= {(q, n + 1, v, -s) for n, (s, v) in enumerate(scored)}
    return out


@pytest.mark.parametrize("pivot_count,block_rows,first_rows", [(4, 16, 10), (7, 40, 1), (32, 2048, 1500)])
def test_search_equals_brute_force(spark, pivot_count, block_rows, first_rows):
    random = np.random.default_rng(1)
    vectors = np.vstack([random.normal(size=(300, 8)), np.tile(random.normal(size=8), (60, 1)), random.normal(size=(40, 8)) * 9])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    table = pivots.quantised(frame)
    found = pivots.top_k(table, F.col("vec_id") % 20 == 0, 5, pivot_count, block_rows, 7, first_rows).collect()
    rows = {r.vec_id: np.array(r.ints) for r in table.collect()}
    assert {tuple(r) for r in found} == _brute(rows, [i for i in rows if i % 20 == 0], 5)


def test_search_prunes_blocks(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(8, 6)) * 20
    vectors = np.vstack([c + random.normal(size=(100, 6)) for c in centres])
    table = pivots.quantised(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    )
    index, space, blocks = pivots.build_index(table, 8, 50)
    asked = index.where("vec_id % 50 = 0").select("vec_id", "ints").withColumn("radius", F.lit(2500.0))
    sent = pivots._route(asked, space, blocks, 100, 1, 1, 5).count()
    assert sum(b.rows for b in blocks) == 800
    assert sent < asked.count() * sum(b.salts for b in blocks) / 2


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (None, [1.0, 1.0]),
            (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [3.0]), (50, []), (100, [-1.0, 0.001])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    table = pivots.quantised(frame)
    found = {tuple(r) for r in pivots.top_k(table, F.col("vec_id") % 50 == 0, 3).collect()}
    ints = {0: [256, 512], 5: [256, 512], 6: [768, 0], 50: [0, 0], 100: [-256, 0]}
    assert found == _brute({k: np.array(v) for k, v in ints.items()}, [0, 50, 100], 3)
    assert pivots.top_k(table.limit(0), F.lit(True)).count() == 0


def strays(rows, weights, block_rows):
    """Largest distance in blocks of any source from its exact target over the balanced part."""
    total = sum(weights.values())
    ordered = [r.source for r in sorted(rows, key=lambda r: r.position) if r.balanced]
    done, worst = dict.fromkeys(weights, 0), Fraction(0)
    for n, source in enumerate(ordered, 1):
        done[source] += 1
        if len(weights) < 50 or n % 97 == 0:
            for s, w in weights.items():
                worst = max(worst, abs(done[s] - n * Fraction(w) / Fraction(total)))
    assert len(ordered) > block_rows
    return worst / block_rows


def test_no_source_strays_a_block_from_its_exact_target(spark):
    rows = [(i, "t", "en", f"s{0 if i % 3 == 0 else i % 7}") for i in range(4000)]
    docs = documents(spark, rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + 1
    found = mixing.mix(docs, temperature=0.6, block_rows=8).collect()
    assert len(found) == 4000 and len({r.position for r in found}) == 4000
    weights = {s: Fraction(round(n**0.6 * 10**6)) for s, n in sizes.items()}
    assert strays(found, weights, 8) < 1
    for r in found:
        w = weights[r.source] / sum(weights.values())
        assert r.release == math.floor((r.block - 1) / w) and r.deadline == math.ceil(r.block / w)


def test_tiny_and_zero_weights_are_met_exactly(spark):
    rows = [(i, "t", "en", "abcde"[0 if i % 40 else 1 + i // 40 % 4]) for i in range(40_000)]
    given = {"a": 0.9998, "b": 0.0001, "c": 0.0001, "d": 0.0}
    found = mixing.mix(documents(spark, rows), given, block_rows=4).collect()
    assert len({r.position for r in found}) == len(rows)
    assert strays(found, {s: Fraction(w).limit_denominator(10**6) for s, w in given.items() if w}, 4) < 1
    last = max(r.position for r in found if r.source in "abc")
    idle = [r for r in found if r.source in "de"]
    assert idle and all(r.position > last and not r.balanced and r.release is None for r in idle)


def test_thousands_of_sources(spark):
    draw = np.random.default_rng(3)
    share = draw.zipf(1.3, 5000).clip(1, 10**6)
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('s', id % 5000) AS source")
    given = {f"s{i}": float(w) for i, w in enumerate(share)}
    found = mixing.mix(docs, given, block_rows=64).collect()
    assert len({r.position for r in found}) == 60_000
    assert strays(found, {s: Fraction(w) for s, w in given.items()}, 64) < 1


def test_given_weights_are_met(spark):
    rows = [(i, "t", "en", "ab"[i % 2]) for i in range(2000)]
    found = mixing.mix(documents(spark, rows), {"a": 3.0, "b": 1.0}, block_rows=10).where("balanced").collect()
    first = [r.source for r in sorted(found, key=lambda r: r.position)][:1200]
    assert abs(first.count("a") - 900) <= 10


def test_mixing_of_odd_rows(spark):
    docs = odd(spark)
    rows = mixing.mix(docs, block_rows=2).collect()
    assert len(rows) == docs.count() and len({r.position for r in rows}) == len(rows)
    assert set(rows[0].asDict()) == set(docs.columns) | {"release", "deadline", "slot", "position", "balanced"}
    clash = docs.withColumnsRenamed({"block": "Slot"}).withColumns({"__id": F.lit(1), "__source": F.lit(2), "row": F.lit(3)})
    again = mixing.mix(clash, block_rows=2)
    assert again.select("__id", "__source", "row").distinct().collect() == [(1, 2, 3)] and "Slot" not in again.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, {"nothing": 1.0}).count() == docs.count()


def _verdict(url):
    start = (url or "").find("://")
    rest = url[start + 3:] if start >= 0 else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups() if start >= 0 else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for verdict, rule in PAGE_RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?y", "http://example.com/EN/",
    "http://a.example.com/en/1#z", "http://notexample.com/en/", "http://xcom/", "ftp://a.b.net/es/", "http://net/fr/?q",
    "http://a.net/fr", "x://y://example.com/en/", "http://example.com?/en/", "http://spam-farm.org/", "http://m.spam-farm.org/x",
    "http://spam-farms.org/", "http://a.org/casino/1", "http://a.org/casino", "http://spam-farm.net/es/1", "http://K.net/es/\nx",
]


def test_urls_get_the_longest_rule(spark):
    pages = spark.createDataFrame(
        [(i, u, "h", "n", 1) for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[5], None, None, None)],
        "page_id long, url string, host string, name string, first int",
    )
    rows = url_rules.judge_urls(pages, PAGE_RULES).collect()
    assert len(rows) == len(URLS) + 4 and rows[0].asDict().keys() == set(pages.columns) | {"path", "rule", "pattern", "verdict"}
    for r in rows:
        host, path, rule, verdict = _verdict(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == verdict and r.pattern is None
    by_url = {r.url: (r.pattern, r.verdict) for r in rows if r.rule is None}
    assert by_url["http://spam-farm.org/"] == ("spam-farm.*", "block")
    assert by_url["http://m.spam-farm.org/x"] == ("*.spam-farm.*", "block")
    assert by_url["http://a.org/casino/1"] == ("*/casino/*", "block")
    assert {by_url[u] for u in ("http://spam-farms.org/", "http://a.org/casino", "", "http://com")} == {(None, "allow")}
    assert url_rules.judge_urls(pages.limit(0), PAGE_RULES).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, (), ()).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("common",)] * 5 + [("rare",)], "token string")
    rules = [url_rules._host_rule("block", "rare.common/x/"), url_rules._glob_rule("*", "block")]
    table = url_rules._rule_table(spark, rules)
    filed = {r.name: r.token for r in url_rules._indexed(table, urls).collect()}
    assert filed == {"rare.common/x/": "x", "*": ""}
    assert url_rules._host_rule("block", "a.b/cd")["tokens"] == ["a", "b"]


def _topics(spark):
    """40 topics of 6 documents of rare words of their own, ids dealt so that a topic is spread out."""
    random = np.random.default_rng(8)
    words = random.permutation([f"{a}{b}" for a in "bcdfghjklmnprstvwz" for b in ("arium", "olent", "ixing", "uddle", "atch", "ember", "ong", "ify", "est", "ound", "ack", "ine", "ory", "ush")])
    rows = []
    for n in range(6):
        for topic in range(40):
            own = random.choice(words[topic * 6:topic * 6 + 6], 40)
            rows.append((len(rows), " ".join(x for w in own for x in ("the", w)), "en", "a"))
    return documents(spark, rows)


def test_neighbours_meet_whatever_the_number_of_shards(spark):
    pieces = packing.pack(_topics(spark), VOCABULARY, window=256, shard_bytes=8_000, with_ids=False).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) > 8
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p.doc_id % 40)
    met = [len(set(t)) < len(t) for t in by_sequence.values() if len(t) > 1]
    assert np.mean(met) > 0.6


def test_statistics_are_those_of_the_whole_table(spark, library):
    docs = small(spark)
    ids = [np.array(x, dtype="<u4") for x in _ids(library, docs.collect()).values()]
    frame = spark.createDataFrame([(bytearray(x.tobytes()), len(x)) for x in ids], "__ids binary, __tokens long")
    held, documents_, mean = packing._statistics(frame.repartition(7))
    assert documents_ == len(ids) and mean == np.mean([len(x) for x in ids])
    assert (held == np.bincount(np.concatenate([np.unique(x) for x in ids]))).all()


def test_terms_of_most_documents_count():
    """Nine of ten documents hold terms 1 to 3: they score against each other, though less than by rare terms."""
    ids = [np.array([1, 2, 3, 100 + n]) for n in range(9)] + [np.array([50, 51])]
    scores = packing.InvertedIndex(ids).scores(ids[0])
    assert (scores[1:9] > 0).all() and scores[9] == 0 and scores[0] > scores[1]
    assert len(set(scores[1:9])) == 1


def test_repeated_rows_are_cut_into_shards(spark):
    docs = documents(spark, [(None, "the same words again " * 50, "en", "a")] * 60)
    pieces = packing.pack(docs, VOCABULARY, window=64, shard_bytes=12_000, with_ids=False).collect()
    sizes = {}
    for p in pieces:
        sizes[p.sequence_id >> 32] = sizes.get(p.sequence_id >> 32, 0) + p.length
    assert len(sizes) > 3 and max(sizes.values()) < sum(sizes.values()) / 2
