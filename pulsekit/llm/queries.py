"""One query per corpus operator, over the whole table it is meant for, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import (
    divergence, langid, licenses, mixing, packing, quality, search, secret_scan, simhash, spelling, toolcalls, toxicity, urls,
)
from pulsekit.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    v = "verdict"
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judge(docs, forest).select("doc_id", *[F.col(f"{v}.{c}").alias(c) for c in counts], F.col(f"{v}.anomaly").alias("anomaly"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", F.explode("licenses").alias("notice")).select("doc_id", "notice.*")


@query("op3_source_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op4_simhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_topk_search")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = docs.where("doc_id % 100 = 0").groupBy(F.col("doc_id").alias("query_id")).agg(F.min("text").alias("text"))
    return search.search(docs, asked)


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = fold("doc_id", 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(rest != 0))
    scored = toxicity.score(docs, model).withColumnRenamed("toxicity", "score")
    return scored.select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# Each user turn calls, the assistant turn behind it answers; later calls depend on the one two turns before.
CALL_SCHEMAS = {
    "ask": {"text": ("string", True), "turn": ("integer", True)},
    "follow_up": {"after": ("string", True), "text": ("string", True), "turn": ("integer", True)},
}
_OP8_SQL = """
WITH calls AS (
  SELECT conv_id, call_id, min({'position': turn, 'name': name, 'text': text}) AS c
  FROM (SELECT conv_id, turn, text, conv_id || '-' || turn AS call_id,
               CASE WHEN role = 'system' THEN 'setup' WHEN turn < 2 THEN 'ask' ELSE 'follow_up' END AS name
        FROM conversations WHERE role IN ('user', 'system')) t
  GROUP BY ALL),
results AS (
  SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, min({'position': turn, 'content': text}) AS r
  FROM conversations WHERE role = 'assistant' GROUP BY ALL),
linked AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.call_id, b.call_id) AS call_id,
         c['name'] AS name, c['position'] AS position, c['text'] AS text, r['position'] AS result_position,
         r['content'] AS content, CASE WHEN a.call_id IS NULL THEN 'no_call' WHEN b.call_id IS NULL THEN 'no_result'
              WHEN r['position'] <= c['position'] THEN 'early_result' ELSE 'linked' END AS status
  FROM calls a FULL JOIN results b ON a.conv_id = b.conv_id AND a.call_id = b.call_id)
SELECT conv_id, call_id, name, position, result_position, status,
       CASE WHEN name IS NOT NULL THEN 0 END AS level,
       CASE WHEN name = 'setup' THEN 'unknown_tool' WHEN name IS NOT NULL AND text IS NULL THEN 'missing:text'
            WHEN name IS NOT NULL THEN '' END AS problems,
       '{' || CASE WHEN name IS NULL THEN '' ELSE '"arguments":{'
                || CASE WHEN name = 'follow_up' THEN '"after":"' || conv_id || '-' || (position - 2) || '",' ELSE '' END
                || CASE WHEN text IS NULL THEN '' ELSE '"text":' || to_json(text)::VARCHAR || ',' END
                || '"turn":' || position || '},' END
           || '"call_id":"' || call_id || '",' || CASE WHEN name IS NULL THEN '' ELSE '"name":"' || name || '",' END
           || CASE WHEN content IS NULL THEN '' ELSE '"result":' || to_json(content)::VARCHAR || ',' END
           || '"status":"' || status || '"}' AS canonical
FROM linked
"""


@query("op8_tool_calls", _OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    name = lambda turn: F.concat("conv_id", F.lit("-"), turn.cast("string"))
    tool = F.when(F.col("role") == "system", "setup").when(F.col("turn") < 2, "ask").otherwise("follow_up")
    before = F.when(tool == "follow_up", name(F.col("turn") - 2))
    calls = turns.where("role IN ('user', 'system')").select(
        "conv_id",
        name(F.col("turn")).alias("call_id"),
        F.col("turn").alias("position"),
        tool.alias("name"),
        F.to_json(F.struct(before.alias("after"), "text", "turn")).alias("arguments"),
        F.when(before.isNotNull(), F.array(before)).alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    linked = toolcalls.link(calls, results, CALL_SCHEMAS)
    return linked.withColumn("problems", F.array_join("problems", ","))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = fold("doc_id", 4)
    model = langid.fit(docs.where(rest != 2))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (rest == 2).alias("held_out"), "language.lang_pred", "language.score")


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Labels of host names whose hosts are listed.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
_OP10_SQL = f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT *, '.' || host AS dotted,
         CASE WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN {" OR ".join(f"contains('.' || host || '.', '.{x}.')" for x in LISTED_LABELS)} THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op10_url_filter", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urls.host(F.col("url")).alias("key")).distinct()
    labels = F.array(*[F.lit(x) for x in LISTED_LABELS])
    cascade = urls.build(hosts.withColumn("listed", F.arrays_overlap(F.split("key", r"\."), labels)))
    return urls.judge(pages, URL_RULES, cascade).select("page_id", "judged.*")


_OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
t AS (SELECT lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
groups AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v) AS BIGINT) AS p
  FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
q AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(total) + any_value(v)) AS BIGINT) AS q
  FROM counts JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang)
  GROUP BY lang, term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query("op12_secret_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secret_scan.fit(secret_scan.labelled_tokens(docs))
    spans = F.col("secrets")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    base = secret_scan.listed(spans, ("assign", "access", "hex"))
    return secret_scan.scan(docs, model).select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret_scan.listed(spans).alias("spans"),
    )


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.words(table(spark, sf_dir, "documents").select("doc_id", "text"), damage=31)
    return spelling.variants(found).select("word", "form", "root", "n", "n_near", "form_n")
