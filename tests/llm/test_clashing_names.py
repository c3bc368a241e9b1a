"""Columns of the result's and of inner names, in other case too, next to a document's own."""

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import VOCABULARY, odd

from shelfcast.llm import compression, exact, jaccard, language, mixing, quality, resampling, substrings, token_count, url_rules

INNER = (
    "__text", "__own", "__doc", "__runs", "__norm", "__hash", "__hash_of", "__row", "__key", "__id", "__source", "__url",
    "__of", "__name", "Row", "carried", "codes", "Label", "id",
)


def _profiles(docs):
    return language.fit_profiles(docs, dimensions=64)


def _scored(docs):
    model = quality.fit(quality.with_statistics(docs).withColumn("label", F.lit(1)), calibrate=F.lit(False))
    return quality.score(quality.with_statistics(docs), model)


#: Operator, names it adds, columns that it takes away.
CASES = {
    "identify": (lambda d: language.identify(d, _profiles(d)), ("lang_pred", "score"), ()),
    "score": (_scored, ("score", "predicted"), ("text",)),
    "count_tokens": (lambda d: token_count.count_tokens(d, VOCABULARY), ("n_bytes", "n_tokens", "over_limit"), ()),
    "remove_repeats": (substrings.remove_repeats, ("n_words", "n_removed", "removed_spans", "kept_text"), ()),
    "drop_similar": (jaccard.drop_similar, (), ()),
    "mix": (mixing.mix, ("block", "release", "deadline", "slot", "position", "balanced"), ()),
    "judge_urls": (lambda d: url_rules.judge_urls(d, [("block", "com/")], url="text"), ("host", "path", "rule", "pattern", "verdict"), ()),
    "mark_copies": (exact.mark_copies, exact.ADDED, ()),
    "drop_copies": (exact.drop_copies, (), ()),
    "keep_one": (exact.keep_one, (), ()),
    "judge": (compression.judge, compression.ADDED, ()),
    "resample": (lambda d: resampling.resample(d, d), resampling.ADDED, ()),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_names_never_clash(spark, name):
    operator, added, gone = CASES[name]
    plain = odd(spark).select("doc_id", "text", "lang", "source")
    clash = plain.withColumns({
        **{c.title().replace("__", "__"): F.lit("theirs") for c in added}, **{c: F.lit("theirs") for c in INNER},
    })
    got = operator(clash)
    lower = {c.lower() for c in added}
    assert got.columns == [c for c in clash.columns if c not in gone and c.lower() not in lower] + list(added)
    rows = got.select("doc_id", *added, *[c for c in INNER if c.lower() not in lower]).collect()
    for r in rows:
        assert all(r[c] == "theirs" for c in INNER if c.lower() not in lower)
    want = operator(plain).select("doc_id", *added)
    assert sorted(map(str, (tuple(r[c] for c in ("doc_id", *added)) for r in rows))) == sorted(str(tuple(r)) for r in want.collect())
