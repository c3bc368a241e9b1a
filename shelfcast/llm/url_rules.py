"""URL verdicts from rules that are indexed by their rarest literal token.

A url is cut into host and path. Its tokens (runs of a-z and 0-9 of the lower-cased host and
path) fetch the rules filed under one of them, and only those run their regular expression.
A rule is filed under the one of its tokens that the urls at hand hold least often; a rule
without a usable token is filed under the empty token, which every url has.
"""

import re

from pyspark.sql import functions as F

from shelfcast.llm.arrow import apart

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Patterns for what no host rule decides: (glob over host and path, verdict).
PATTERNS = (
    ("spam-farm.*", "block"),
    ("*.spam-farm.*", "block"),
    ("cheap-pills.*", "block"),
    ("*.cheap-pills.*", "block"),
    ("*/casino/*", "block"),
    ("*/adult/*", "block"),
    ("*/phishing/*", "block"),
)


def host_and_path(url):
    """Host (A-Z lower-cased) and path; both empty for null and for no `://`."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, _PARTS, 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(text, _PARTS, 2)


def _whole_tokens(literal, open_left, open_right):
    """Runs of a-z and 0-9 that any url holding the literal has as whole tokens."""
    low = literal.lower()
    return [
        m.group() for m in re.finditer(r"[a-z0-9]+", low)
        if (m.start() > 0 or not open_left) and (m.end() < len(low) or not open_right)
    ]


def _host_rule(verdict, rule):
    """`host/path`: fits the host and its subdomains, paths that start with the rule's."""
    host, slash, rest = rule.partition("/")
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    literal = host + slash + rest
    return {
        "name": rule, "verdict": verdict, "first": 2,
        "regex": r"^(?:[^/]*\.)?" + _quoted(literal),
        "tokens": _whole_tokens(literal, False, True),
    }


def _glob_rule(glob, verdict):
    """`*` stands for any characters; the rest must stand as written, from end to end."""
    parts, last = glob.split("*"), glob.count("*")
    tokens = [
        t for i, p in enumerate(parts) for t in _whole_tokens(p, i > 0, i < last)
    ]
    regex = "(?s)^" + ".*".join(_quoted(p) for p in parts) + r"\z"
    return {"name": glob, "verdict": verdict, "first": 1, "regex": regex, "tokens": tokens}


def _quoted(text):
    return re.sub(r"([^A-Za-z0-9/_ -])", r"\\\1", text)


def _tokens(target):
    return F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit("[a-z0-9]+"), F.lit(0)))


def _rule_table(spark, rules):
    rows = [
        F.struct(
            F.lit(r["name"]).alias("name"), F.lit(r["verdict"]).alias("rule_verdict"),
            F.lit(r["first"]).alias("first"), F.lit(r["regex"]).alias("regex"),
            F.array(*[F.lit(t) for t in r["tokens"] or [""]]).alias("tokens"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _indexed(table, exploded):
    """Each rule with its rarest token, by the rows of the urls that hold it."""
    filed = table.select("name", "first", F.explode("tokens").alias("token"))
    seen = exploded.join(filed.select("token").distinct(), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    rarest = (
        filed.join(counts, "token", "left").groupBy("name", "first")
        .agg(F.min(F.struct(F.coalesce("rows", F.lit(0)), "token")).alias("best"))
        .select("name", "first", F.col("best.token").alias("token"))
    )
    return table.drop("tokens").join(rarest, ["name", "first"])


def judge_urls(pages, rules, patterns=PATTERNS, default="allow", url="url"):
    """All columns of `pages` with host, path, rule, pattern and verdict.

    `rules` are (verdict, "host/path") pairs: the longest one that fits decides. Where none
    fits, the longest of `patterns` that matches decides, else `default`. Rules of equal
    length: block before allow, then the name that sorts first. `rule` and `pattern` name
    what decided, null if it did not. A null url or one without `://` has an empty host and
    path, which no host rule fits. Equal urls get equal verdicts, so repeated rows are
    harmless; columns of the result's names that were there before, in whatever case, are replaced.

    Only tokens of distinct urls are shuffled with their candidates; the rules are a small
    table whose join Spark chooses by size.
    """
    added = ("host", "path", "rule", "pattern", "verdict")
    return apart(pages, {"url": url}, added, lambda rows: _judged(rows, rules, patterns, default))


def _judged(pages, rules, patterns, default):
    spark, url = pages.sparkSession, F.col("url")
    host, path = host_and_path(url)
    rows = pages.select("*", F.coalesce(url, F.lit("")).alias("__url"), host.alias("host"), path.alias("path"))
    given = [_host_rule(*r) for r in rules] + [_glob_rule(*p) for p in patterns]
    none = F.lit(None).cast("string")
    if not given:
        return rows.drop("__url").withColumns(
            {"rule": none, "pattern": none, "verdict": F.lit(default)}
        )
    targets = rows.select("__url", F.concat("host", "path").alias("target"))
    exploded = targets.select(
        "__url", "target", F.explode(F.array_union(_tokens(F.col("target")), F.array(F.lit("")))).alias("token")
    )
    index = _indexed(_rule_table(spark, given), exploded.select("token"))
    rank = F.struct(
        "first", F.length("name").alias("long"), (F.col("rule_verdict") == "block").alias("blocks"),
    )
    hits = exploded.join(index, "token").where("target rlike regex")
    best = (
        hits.groupBy(F.col("__url").alias("__of"), rank.alias("rank"))
        .agg(F.min(F.struct("name", "rule_verdict")).alias("hit"))
        .groupBy("__of").agg(F.max_by("hit", "rank").alias("hit"), F.max("rank").alias("rank"))
        .select(
            "__of", F.col("hit.name").alias("__name"), F.col("hit.rule_verdict").alias("__verdict"),
            F.col("rank.first").alias("__first"),
        )
    )
    joined = rows.join(best, F.col("__url") == F.col("__of"), "left")
    return joined.withColumns({
        "rule": F.when(F.col("__first") == 2, F.col("__name")),
        "pattern": F.when(F.col("__first") == 1, F.col("__name")),
        "verdict": F.coalesce("__verdict", F.lit(default)),
    })
