"""Collocations, compression rules and resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from shelfcast.llm import collocations, compression, resampling
from tests.llm.helpers import UPPER, WORDS, documents, odd, small


# --- collocations ---------------------------------------------------------
def phrases_by_hand(rows, least, top=2000, longest=4):
    """(lang, text) rows to the result of `mine`, with every run of words kept in memory."""
    counts, total = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    found = []
    for lang, own in counts.items():
        often = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        lines = []
        for p, a in often.items():
            longer = [b for q, b in often.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            lines.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


def mined(docs, **settings):
    got = collocations.mine(docs, **settings)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_brute_force(spark):
    docs = small(spark)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert mined(docs, least=12) == phrases_by_hand(rows, 12)
    assert mined(docs, least=12, top=7) == phrases_by_hand(rows, 12, top=7)


def test_phrases_of_random_words_windows_and_slices(spark, monkeypatch):
    draw = random.Random(5)
    words = ["a", "b", "Ä", "c d", "e-", "F", "\x00", "."]
    rows = [
        (draw.choice(["en", None, "und", "fr"]),
         "".join(draw.choice(words) + draw.choice([" ", "\t", "  ", ", ", "\n", " "]) for _ in range(draw.randrange(60))))
        for _ in range(200)
    ]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    whole = phrases_by_hand(rows, 5)
    assert mined(docs, least=5) == whole
    # one bit for all phrases: every filter passes, nothing changes
    assert mined(docs, least=5, bits=64) == whole
    # windows and slices of a few words; tasks are other processes, so the generator is run here
    monkeypatch.setattr(collocations, "WINDOW_WORDS", 16)
    monkeypatch.setattr(collocations, "_SLICE", 5)
    text = " ".join(t for _, t in rows)
    window = collocations._Window()
    window.add(text.encode().lower())
    got = Counter()
    for batch in collocations._stripes("en", window, (2,), None, 64):
        for r in batch.to_pylist():
            for following, n in zip(r["next"], r["n"]):
                got[f"{r['prefix']} {following}"] += n
    want = Counter()
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER)):
        own = re.findall(r"[^\x20\x09]+", piece)
        want.update(" ".join(own[i:i + 3]) for i in range(len(own) - 2))
    assert got == want


def test_counted_rows_of_numbers_of_any_width():
    import numpy as np

    random = np.random.default_rng(2)
    for known in (3, 2**20, 2**31):
        for size in (1, 2, 3, 4):
            pool = random.integers(0, known, (40, size))
            rows = pool[random.integers(0, 40, 500)]
            columns, n = collocations._counted(list(rows.T), known)
            got = list(zip(*(c.tolist() for c in columns)))
            assert got == sorted(got) and dict(zip(got, n.tolist())) == Counter(map(tuple, rows.tolist()))
    columns, n = collocations._counted([np.zeros(0, np.int64)] * 3, 5)
    assert len(n) == 0 and len(columns) == 3


def test_map_of_frequent_phrases_is_the_same_in_tasks_and_in_spark(spark):
    words = ["a", "été", "zz z".replace(" ", " ")]
    hashes = collocations._hashes("en", [w.encode() for w in words])
    for size in (2, 3):
        bit = collocations._bit(F.lit("en"), F.array(*map(F.lit, words)), size, 2**20)
        assert spark.range(1).select(bit).first()[0] == collocations._bits_of(hashes[:size].reshape(size, 1), 2**20)[0]


def test_phrases_of_odd_rows(spark):
    rows = [(r["lang"], r["text"]) for r in odd(spark).collect()]
    assert mined(odd(spark), least=2) == phrases_by_hand(rows, 2)
    assert mined(odd(spark).limit(0)) == []
    # a task that repeats one pair a hundred thousand times, and a stripe with many next words
    pair = [("en", "big pair. " * 100_000), ("en", " ".join(f"the w{i}." for i in range(5000)))]
    got = mined(spark.createDataFrame(pair, "lang string, text string"), least=3)
    assert got == [("en", 1, "big pair", 100_000, 100_000, 100_000, 210_000, 1_000_000)]


def test_scores_beyond_64_bits(spark):
    many = 4 * 10**18
    table = [("en", "", 0, many), ("en", "a", 1, many), ("en", "b", 1, many - 1), ("en", "a b", 2, many - 2)]
    phrases = spark.createDataFrame(table, "lang string, phrase string, words int, a long")
    row = collocations.scored(phrases).first()
    assert (row["a"], row["l"], row["r"]) == (many - 2, many, many - 1)
    assert row["score"] == 2_000_000 * (many - 2) // (2 * many - 1)


# --- compression rules ----------------------------------------------------
def judged(docs, **settings):
    return compression.judge(docs, **settings).collect()


def base_by_hand(text):
    words = WORDS.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts_and_verdict_equal_brute_force(spark):
    own = [
        (100, "a b c " * 30, "en", "a"), (101, "a\nb\na\n\n\na \n|<#>| é é", "en", "a"),
        (102, "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz0123456789+/ABCDEFGHIJKLMNOPQRSTUVWXYZ \x00\x01~^")
                      for _ in range(9000)), "en", "a"),
        (103, " ".join(f"{i} number{i * 7919 % 1000}" for i in range(400)), "en", "a"),
    ]
    for docs in (small(spark), documents(spark, own), odd(spark)):
        for r in judged(docs):
            data = (r["text"] or "").encode()
            assert tuple(r[c] for c in compression.COUNTS) == base_by_hand(r["text"])
            ratio = len(data) / len(zstandard.compress(data, 3)) if data else 1.0
            assert r["ratio"] == pytest.approx(ratio, rel=0.02) and r["n_chunks"] == -(-len(data) // 4096)
            assert r["base_failed"] == (r["n_words"] < 50 or r["n_repeat_words"] * 100 > 50 * r["n_words"])
            assert r["kept"] == (r["in_band"] and not r["base_failed"])


def test_bands_find_repeats_and_noise_and_leave_prose(spark):
    draw = random.Random(9)
    prose = " ".join(r["text"] or "" for r in small(spark).where("doc_id < 60").collect())[:20_000]
    noise = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ") for _ in range(20_000))
    rows = [
        (1, prose, None, None), (2, prose[:600], None, None), (3, noise, None, None),
        (4, "buy now and save " * 400, None, None), (5, prose[:8192] + "abc " * 1024 + prose[8192:], None, None),
        (6, prose[:8192] + "abc " * 4096, None, None), (7, "hm", None, None),
    ]
    in_band = {r["doc_id"]: r["in_band"] for r in judged(documents(spark, rows))}
    # one bad chunk in six is within the allowance, four of six are not
    assert in_band == {1: True, 2: True, 3: False, 4: False, 5: True, 6: False, 7: True}


def test_judged_rows_keep_their_columns(spark):
    docs = odd(spark).withColumns({"Ratio": F.lit(1), "ROW": F.lit(2), "Kept": F.lit("x"), "a.b": F.lit(3)})
    got = compression.judge(docs)
    assert got.columns == [c for c in docs.columns if c not in ("Ratio", "Kept", "kept")] + list(compression.ADDED)
    assert got.select("ROW", "`a.b`").distinct().collect() == [(2, 3)]
    assert compression.judge(docs.limit(0)).count() == 0


# --- resampling -----------------------------------------------------------
def drawn_by_hand(rows, target, percent, min_words, buckets, seed, size=1):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        runs = [" ".join(words[i:i + n]) for n in range(1, size + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for *_, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    lines = []
    for i, n, f in own:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in f]
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gains) // len(gains) if gains else 0
        lines.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    asked = sorted((-x[3], x[0] is None, x[0] or 0) for x in lines if x[4] >= min_words)
    best = asked[:len(asked) * percent // 100]
    return lines, best


def test_draw_equals_brute_force(spark):
    docs, target = small(spark), small(spark, "benchmark")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts = [r["text"] for r in target.collect()]
    for percent, size in ((10, 1), (37, 2), (100, 1)):
        lines, best = drawn_by_hand(rows, texts, percent, 20, 10_000, 2024, size)
        got = resampling.resample(docs, target, percent=percent, size=size, with_text=False).collect()
        assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == sorted(x[:4] for x in lines)
        winners = sorted((r["rank"], r["doc_id"]) for r in got if r["rank"] is not None)
        assert winners == [(i, doc) for i, (_, _, doc) in enumerate(best, 1)]


def test_draw_of_odd_rows_counts_right(spark):
    docs = odd(spark).unionByName(odd(spark)).withColumns({"Rank": F.lit(1), "ROW": F.lit(2), "Key": F.lit(3)})
    got = resampling.resample(docs, small(spark, "benchmark"), percent=50, min_words=0)
    assert got.columns == [c for c in docs.columns if c not in ("score", "Rank")] + list(resampling.ADDED)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert sorted(r["rank"] for r in rows if r["rank"] is not None) == list(range(1, docs.count() // 2 + 1))
    best = sorted((-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    taken = sorted((-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in rows if r["rank"] is not None)
    assert taken == best[:len(taken)]
    empty = docs.limit(0)
    assert resampling.resample(empty, empty).count() == 0
    assert resampling.resample(docs, empty, percent=0).where("rank is not null").count() == 0


def test_quickselect_meets_every_rank(spark):
    keys = spark.range(500).select(F.struct((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"),
                                            F.col("id").alias("place")).alias("key")).cache()
    want = [r["key"] for r in keys.orderBy("key").collect()]
    for k in (1, 2, 77, 250, 499, 500):
        assert resampling.kth_key(keys, k, pivots=3) == want[k - 1]
    with pytest.raises(ValueError):
        resampling.kth_key(keys, 501)
