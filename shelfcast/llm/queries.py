"""The registered queries of this subpackage and their SQL checks."""

from functools import wraps

from pyspark.sql import functions as F

from shelfcast.llm import (
    collocations,
    compression,
    exact,
    jaccard,
    language,
    mixing,
    packing,
    pivots,
    quality,
    resampling,
    substrings,
    token_count,
    url_rules,
)
from shelfcast.llm.arrow import id_remainder
from shelfcast.session import cut_lineage, ship_package

QUERIES, SQL = {}, {}

#: Rules of the page query, in the form (verdict, host/path).
PAGE_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


def query(name, sql=None):
    """Registers `fn(spark, sf_dir) -> DataFrame`."""

    def add(fn):
        @wraps(fn)
        def run(spark, folder):
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name="byte_bpe_50k.json"):
    """Path of a public tokenizer's file on the driver."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_language_id")
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    part = id_remainder("doc_id", 3)
    profiles = language.fit_profiles(docs.where(part != 1), dimensions=1024)
    asked = docs.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "text")
    return language.identify(asked, profiles).drop("text")


@query("op2_quality_scores")
def op2_quality_scores(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = cut_lineage(quality.with_statistics(docs))
    labels = (
        table(spark, folder, "labels").where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").alias("labelled")).agg(F.avg("quality").alias("label"))
    )
    part = id_remainder("doc_id", 5)
    taught = stats.join(labels, F.col("doc_id") == F.col("labelled")).where(part != 0)
    model = quality.fit(taught, calibrate=part == 1)
    return quality.score(stats.withColumn("held_out", F.coalesce(part == 0, F.lit(False))), model, 0.3)


@query("op3_token_counts")
def op3_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, vocabulary(), limit=512).drop("text")


@query("op4_retrieval_packing")
def op4_retrieval_packing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary(), window=1024, end_id=0, with_ids=False)


@query("op5_substring_dedup")
def op5_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = substrings.remove_repeats(docs, window=20)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_exact_top_k", """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256))) AS ints FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""")
def op6_exact_top_k(spark, folder):
    table_of = pivots.quantised(table(spark, folder, "embeddings"))
    return pivots.top_k(table_of, F.col("vec_id") % 50 == 0, k=5)


@query("op7_ngram_jaccard")
def op7_ngram_jaccard(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.similar_groups(docs, size=3, top=90, bottom=100)


@query("op8_source_mix", """
WITH RECURSIVE keyed AS (
  SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), sizes AS (
  SELECT source, count(*) AS n, CAST(round(pow(count(*), 0.7) * 1000000) AS HUGEINT) AS w,
    row_number() OVER (ORDER BY source) - 1 AS i FROM keyed GROUP BY source
), facts AS (
  SELECT CAST(ceil(log2(count(*))) AS INT) AS levels, CAST(sum(w) AS HUGEINT) AS total FROM sizes
), cut AS (
  SELECT levels, total, 64 // CAST(pow(2, floor(log2(greatest(levels // 2, 0.5))) + 1) AS BIGINT) AS unit_rows FROM facts
), nodes AS (
  SELECT k, i >> k AS node, CAST(sum(w) AS HUGEINT) AS w
  FROM sizes, (SELECT unnest(range(0, 40)) AS k) WHERE k <= (SELECT levels FROM facts) GROUP BY ALL
), ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1 AS r FROM keyed
), asked AS (
  SELECT DISTINCT source, r // unit_rows + 1 AS unit FROM ranked, cut
  UNION SELECT source, (n + unit_rows - 1) // unit_rows + 1 FROM sizes, cut
), climb AS (
  SELECT a.source, a.unit, s.i, CAST(0 AS INT) AS k, CAST(a.unit AS HUGEINT) AS n FROM asked a JOIN sizes s USING (source)
  UNION ALL
  SELECT c.source, c.unit, c.i, c.k + 1, CASE WHEN (c.i >> c.k) % 2 = 0
    THEN ((2 * c.n - 1) * both_.w + 2 * own.w - 1) // (2 * own.w) ELSE ((2 * c.n - 1) * both_.w) // (2 * own.w) + 1 END
  FROM climb c JOIN nodes own ON own.k = c.k AND own.node = c.i >> c.k
    JOIN nodes both_ ON both_.k = c.k + 1 AND both_.node = c.i >> (c.k + 1)
), placed AS (
  SELECT source, unit, CAST(n - 1 AS BIGINT) AS spot FROM climb, facts WHERE k = levels
), ends AS (
  SELECT min(spot) AS finish FROM placed JOIN sizes USING (source), cut WHERE unit = (n + unit_rows - 1) // unit_rows + 1
)
SELECT q.doc_id, q.source, r // 64 + 1 AS block, CAST((r // 64) * total // w AS BIGINT) AS release,
  CAST(((r // 64 + 1) * total + w - 1) // w AS BIGINT) AS deadline,
  (spot * unit_rows + r % unit_rows) // 64 AS slot, spot * unit_rows + r % unit_rows AS position, spot < finish AS balanced
FROM ranked q JOIN sizes s ON s.source = q.source CROSS JOIN cut CROSS JOIN ends
  JOIN placed p ON p.source = q.source AND p.unit = r // unit_rows + 1
""")
def op8_source_mix(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, temperature=0.7, block_rows=64)


@query("op9_url_rules", """
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT page_id, p.host, p.path, hit.rule,
  CASE WHEN hit.rule IS NULL AND pattern IS NOT NULL THEN pattern END AS pattern,
  coalesce(hit.verdict, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM (
  SELECT *, CASE
    WHEN contains('.' || host || path, '.spam-farm.') AND NOT starts_with(host || path, 'spam-farm.') THEN '*.spam-farm.*'
    WHEN contains('.' || host || path, '.cheap-pills.') AND NOT starts_with(host || path, 'cheap-pills.') THEN '*.cheap-pills.*'
    WHEN starts_with(host || path, 'cheap-pills.') THEN 'cheap-pills.*'
    WHEN contains(path, '/phishing/') THEN '*/phishing/*'
    WHEN starts_with(host || path, 'spam-farm.') THEN 'spam-farm.*'
    WHEN contains(path, '/casino/') THEN '*/casino/*'
    WHEN contains(path, '/adult/') THEN '*/adult/*' END AS pattern
  FROM parts) p
LEFT JOIN LATERAL (
  SELECT r.host || r.path AS rule, r.verdict FROM rules r
  WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  ORDER BY length(r.host || r.path) DESC LIMIT 1) hit ON true
""")
def op9_url_rules(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, PAGE_RULES).drop("url")


@query("op10_exact_dedup", """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
""")
def op10_exact_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact.mark_copies(docs).drop("text")


@query("op11_collocations", """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), runs AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0
), sized AS (
  SELECT lang, w, i, unnest([1, 2, 3, 4]) AS k FROM runs
), counted AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM sized WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), often AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30
), cuts AS (
  SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS cut FROM often WHERE k > 1
), parts AS (
  SELECT c.*, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
), best AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_of AS (
  SELECT o.lang, o.f, s.size, unnest(range(1, o.k - s.size + 2)) AS i, o.w
  FROM often o, (VALUES (2), (3)) s(size) WHERE s.size < o.k
), longer AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS f FROM inner_of GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
  b.phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
WHERE g.f IS NULL OR 100 * g.f < 80 * a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) <= 2000
""")
def op11_collocations(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "text")
    return collocations.mine(docs, least=30, longest=4, subsumed_percent=80, top=2000)


@query("op12_quality_rules")
def op12_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return compression.judge(docs).drop("text")


@query("op13_resampling")
def op13_resampling(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    target = table(spark, folder, "benchmark").select("text")
    return resampling.resample(docs, target, percent=10, min_words=20, buckets=10_000, seed=2024, with_text=False)
