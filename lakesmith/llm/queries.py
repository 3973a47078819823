"""Registered queries of the training-data operators, with DuckDB SQL where
SQL can express them.  Each query runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.llm import (alignment, decontaminate, fingerprint, line_dedup, mixing, phrases, quality, repeats, secrets,
                           sharding, simhash, toxicity, url_filter)
from lakesmith.llm.common import table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


# -- 1: SimHash near-duplicates ------------------------------------------------

@register("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document (4-word shingles, 4 bits)."""
    found = simhash.near_duplicate_classes(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(F.col("__id").alias("doc_id"), simhash.hex_digits(F.col("__fp")).alias("fingerprint"),
                        "component_id")


# -- 2: mixing sources to target weights ---------------------------------------

def _op2_sql() -> str:
    """The same raking, its rounds written out as common table expressions."""
    parts = [f"""
doc AS (
  SELECT doc_id, coalesce(source, '{mixing.NONE}') AS source, coalesce(lang, '{mixing.NONE}') AS lang,
         CASE WHEN contains(t, 'icense') THEN 'legal' WHEN contains(t, '=') THEN 'technical'
              WHEN contains(t, '@') THEN 'contact' ELSE 'prose' END AS topic,
         len(regexp_extract_all(t, '[^ \t\n\r]+')) AS n_tokens,
         ('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t)), 1, 13))
           ::BIGINT / pow(2, 52) AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cell AS (SELECT source, lang, topic, sum(greatest(n_tokens, 1)) AS tokens FROM doc GROUP BY ALL)"""]
    for m in mixing.MARGINS:
        parts.append(f"""
target_{m} AS (
  SELECT {m}, pow(n, {mixing.TEMPER}) / sum(pow(n, {mixing.TEMPER})) OVER () AS t_{m}
  FROM (SELECT {m}, sum(tokens) AS n FROM cell GROUP BY {m}))""")
    parts.append("""
step0 AS (
  SELECT *, CAST(tokens AS DOUBLE) AS weight
  FROM cell JOIN target_source USING (source) JOIN target_lang USING (lang) JOIN target_topic USING (topic))""")
    last = 0
    for _ in range(mixing.ROUNDS):
        for m in mixing.MARGINS:
            parts.append(f"""
step{last + 1} AS MATERIALIZED (
  SELECT * REPLACE (weight * t_{m} / sum(weight) OVER (PARTITION BY {m}) AS weight) FROM step{last})""")
            last += 1
    return f"""WITH {",".join(parts)},
chance AS (SELECT source, lang, topic, (weight / tokens) / max(weight / tokens) OVER () AS p FROM step{last})
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, u < p AS sampled
FROM doc JOIN chance USING (source, lang, topic)"""


@register("op2_mixing", _op2_sql())
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated probability and draw of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return mixed.select("doc_id", *[F.coalesce(c, F.lit(mixing.NONE)).alias(c) for c in ("source", "lang")], "topic",
                        "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


# -- 3: benchmark decontamination ----------------------------------------------

@register("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verified overlap of a document with a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return (marked.where(F.size("overlaps") > 0).select("doc_id", F.explode("overlaps").alias("o"))
            .select("doc_id", "o.item_id", "o.start", "o.end", "o.matched", "o.item_tokens"))


# -- 4: secret scan ------------------------------------------------------------

@register("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id", *[secrets.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


# -- 5: sharding ---------------------------------------------------------------

SHARDS = 40


@register("op5_shards")
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by one at most."""
    text = text_of()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.shuffle_into_shards(docs, SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# -- 6: toxicity ---------------------------------------------------------------

@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"),
                                    "score", "predicted")


# -- 7: repeated strings -------------------------------------------------------

@register("op7_repeats")
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 50-byte string of a smaller doc_id."""
    out = repeats.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.when(F.col("no") != repeats.LAST, F.col("no")).alias("doc_id"), "n_bytes", "n_removed",
                      "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# -- 8: line deduplication -----------------------------------------------------

OP8_SQL = """
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, generate_subscripts(lines, 1) AS no, unnest(lines) AS l FROM doc),
full_line AS (
  SELECT doc_id, no, l, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS p,
         count(*) OVER (PARTITION BY doc_id) AS n, len(regexp_extract_all(l, '[^ \t\r]+')) AS w
  FROM line WHERE trim(l, ' ') <> ''),
run AS (
  SELECT doc_id, p, n, l AS l1, lead(l, 1) OVER d AS l2, lead(l, 2) OVER d AS l3, w AS w1, w + lead(w, 1) OVER d AS w2
  FROM full_line WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
judged AS (
  SELECT doc_id, p, 1 AS k, (w1 >= 50 OR n = 1) AND (doc_id, p) > min((doc_id, p)) OVER (PARTITION BY l1) AS later FROM run
  UNION ALL
  SELECT doc_id, p, 2, (w2 >= 50 OR n = 2 AND p = 1) AND (doc_id, p) > min((doc_id, p)) OVER (PARTITION BY l1, l2) FROM run WHERE l2 IS NOT NULL
  UNION ALL
  SELECT doc_id, p, 3, (doc_id, p) > min((doc_id, p)) OVER (PARTITION BY l1, l2, l3) FROM run WHERE l3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS p FROM judged WHERE later),
numbered AS (
  SELECT f.doc_id, f.no, g.p, lag(g.p) OVER (PARTITION BY f.doc_id ORDER BY f.no) AS before
  FROM full_line f LEFT JOIN gone g USING (doc_id, p)),
kept AS (
  SELECT line.doc_id, string_agg(line.l, chr(10) ORDER BY line.no) FILTER (n.p IS NULL) AS t, count(n.p) AS n_removed,
         count(*) FILTER (n.p IS NOT NULL AND n.before IS NULL) AS runs, count(*) AS n_lines
  FROM line LEFT JOIN numbered n USING (doc_id, no) GROUP BY line.doc_id)
SELECT doc_id, n_lines, n_removed, runs, sha256(coalesce(t, '')) AS kept_sha256 FROM kept
"""


@register("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs of three lines, fifty words or a whole document, later copies deleted."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "runs",
                      F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# -- 9: document fingerprints --------------------------------------------------

@register("op9_fingerprint")
def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    out = fingerprint.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnRenamed("id", "doc_id")


# -- 10: URL filter ------------------------------------------------------------

URL_RULES = [
    url_filter.host_path_rule("com/", "allow"),
    url_filter.host_path_rule("example.com/en/", "block"),
    url_filter.host_path_rule("www.example.com/en/", "allow"),
    url_filter.host_path_rule("net/es/", "block"),
    url_filter.host_path_rule("net/fr/", "block"),
    # gambling and adult hosts: the word stands as a whole token of the host
    *[url_filter.pattern_rule(f"host:{w}", "block", rf"^[^/?#]*(?<![0-9a-z]){w}(?![0-9a-z])", w)
      for w in ("adult", "bets", "casino", "gambling", "jackpot", "poker", "porn", "slots", "viagra", "xxx")],
    url_filter.pattern_rule("path:adult", "block", r"/adult(?:/|$)", "adult"),
]

_SPAM = "adult|bets|casino|gambling|jackpot|poker|porn|slots|viagra|xxx"
OP10_SQL = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         coalesce(strpos(url, '://') > 0, false) AS whole
  FROM pages),
split AS (
  SELECT page_id, whole, rest,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^#]*)', 1) AS tail
  FROM parts),
judged AS (
  SELECT page_id, host, path, tail, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[^0-9a-z])({_SPAM})($|[^0-9a-z])') THEN 'block'
    WHEN regexp_matches(tail, '/adult(/|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
"""


@register("op10_url_filter", OP10_SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


# -- 11: phrase collocations ---------------------------------------------------

OP11_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
split AS (SELECT lang, row_number() OVER () AS no, regexp_extract_all(p, '[^\x20\x09]+') AS words FROM piece),
word AS (SELECT lang, no, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM split),
gram AS (
  SELECT lang, w AS w1, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM word WINDOW s AS (PARTITION BY no ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM gram GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM gram WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM gram WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
around AS (
  SELECT lang, w1, w2, max(f) AS most
  FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
kept AS (
  SELECT t.* FROM two t LEFT JOIN around USING (lang, w1, w2) WHERE most IS NULL OR 100 * most < 50 * t.f),
cut AS (
  SELECT k.lang, k.w1 || ' ' || k.w2 AS phrase, 1 AS k, k.f AS a, x.f AS l, y.f AS r
  FROM kept k JOIN one x ON (k.lang, k.w1) = (x.lang, x.w1) JOIN one y ON (k.lang, k.w2) = (y.lang, y.w1)
  UNION ALL
  SELECT k.lang, k.w1 || ' ' || k.w2 || ' ' || k.w3, 1, k.f, x.f, y.f
  FROM three k JOIN one x ON (k.lang, k.w1) = (x.lang, x.w1) JOIN two y ON (k.lang, k.w2, k.w3) = (y.lang, y.w1, y.w2)
  UNION ALL
  SELECT k.lang, k.w1 || ' ' || k.w2 || ' ' || k.w3, 2, k.f, x.f, y.f
  FROM three k JOIN two x ON (k.lang, k.w1, k.w2) = (x.lang, x.w1, x.w2) JOIN one y ON (k.lang, k.w3) = (y.lang, y.w1)),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cut),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN total USING (lang) QUALIFY rank <= 2000
"""


@register("op11_phrases", OP11_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two or three words of every language."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return phrases.mine_phrases(docs, max_words=3, min_count=10, top=2000, subsumed_percent=50)


# -- 12: quality ---------------------------------------------------------------

@register("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", F.coalesce(quality.fold() == 0, F.lit(False)).alias("held_out"),
                                    "score", "predicted")


# -- 13: cross-tokenizer alignment ---------------------------------------------

TOKENIZERS = "/opt/tokenizers"


@register("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of every document under both public tokenizers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, alignment.Tokenizers.read(TOKENIZERS))
