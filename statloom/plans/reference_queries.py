"""Registered queries of the extraction, analytics, audit, batching, validation and merge operators, with their SQL."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions import patterns as P
from statloom.functions import text as tx
from statloom.operators import analytics, audit, batching, extract, findings, merge, nested, prioritize, progress, responses, structured, validate
from statloom.plans.data_queries import _P2, _P2_VALUES
from statloom.sources import readers, sinks
from statloom.runtime import scratch, spread, table, written
from statloom.streaming import streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


#: Lengths and sizes that SQL gives as 64-bit integers.
WIDE = {
    "scan_articles": ("text_length",),
    "text_length": ("text_length",),
    "lookup_join": ("text_length",),
    "extract_*": ("hits",),
    "structured_findings_count": ("findings",),
    "table_section_count": ("sections",),
    "priority_page": ("body_length",),
    "audit_high": ("found", "checked"),
    "audit_count_match": ("extracted", "manual"),
    "audit_low": ("extracted", "found", "missed"),
    "structured_places": ("start",),
    "raw_interval_hits": ("intervals",),
    "ascii_text": ("ascii_title", "ascii_text"),
    "match_context": ("pos",),
}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        wide = WIDE.get(key, WIDE["extract_*"] if key.startswith("extract_") and key != "extract_long" else ())
        QUERIES[key] = f if not wide else lambda spark, d: f(spark, d).withColumns({c: F.col(c).cast("long") for c in wide})
        if sql:
            ORACLES[key] = sql
        return f

    return add


# ---- inputs, in both languages -------------------------------------------------------------------------------------


def arts(spark, d):
    return readers.articles(table(spark, d, "articles"))


def extracted(spark, d, profile="implemented"):
    cols = ["id", "pmc_id", "journal", "pub_year", "text"]
    return extract.extract(spread(arts(spark, d).select(*cols)), profile)


def scores(spark, d, profile="implemented"):
    """id, journal, pub_year and rigor_score: for all that needs no matches."""
    return extract.scored(spread(arts(spark, d).select("id", "journal", "pub_year", "text")), profile).drop("text")


def fs(spark, d):
    return findings.typed(table(spark, d, "merged_statistics"))


def fx(spark, d):
    return findings.by_extractor(fs(spark, d))


def _fx_once(spark, d):
    """The same, read and written once as the numbers that all kinds' merges need."""
    return written(fx(spark, d).select("pmc_id", *merge.MERGED), "typed-findings")


def _hits(col: str, pats: list[str], ignore: bool = True, **kw) -> str:
    return f"regexp_extract_all({col}, {dialect.sql(dialect.alternation(pats), ignore_case=ignore, **kw)})"


A = "a AS (SELECT *, coalesce(full_text, body) AS text FROM articles WHERE coalesce(full_text, body) IS NOT NULL)"


def x_sql(profile: str = "implemented") -> str:
    cat, ignore = P.CATALOGUES[profile]
    cols = ", ".join(f"list_distinct({_hits('text', cat[c], ignore)}) AS {c}" for c in P.CATEGORIES)
    score = " + ".join(f"CASE WHEN len({c}) > 0 THEN {w} ELSE 0 END" for c, w in P.WEIGHTS[profile].items())
    return f"{A}, x0 AS (SELECT id, pmc_id, journal, pub_year, text, {cols} FROM a), x AS (SELECT *, CAST({score} AS INTEGER) AS rigor_score FROM x0)"


X = x_sql()
FT = r"""
f0 AS (SELECT *, regexp_replace(regexp_replace(lower(trim(statistic_type)), '[\s_-]+', '_', 'g'), 's$', '') AS kind,
    CASE WHEN json_valid(value) THEN value END AS j, lower(trim(source)) AS src FROM merged_statistics),
f AS (SELECT *,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.lower', j->>'$.value.lower', j->>'$[0]', j->>'$.value[0]') AS DOUBLE) END AS lo,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.upper', j->>'$.value.upper', j->>'$[1]', j->>'$.value[1]') AS DOUBLE) END AS hi,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.level', j->>'$.value.level', j->>'$[2]') AS DOUBLE) END AS level,
    CASE WHEN kind <> 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.value', j->>'$') AS DOUBLE) END AS num,
    CASE WHEN kind = 'effect_size' THEN regexp_replace(lower(j->>'$.type'), '[\s-]+', '_', 'g') END AS name FROM f0)"""
FX = FT + """,
fx AS (SELECT f.*, e.extractor FROM f, (SELECT unnest(['llm', 'regex']) AS extractor) e WHERE f.src = 'both' OR f.src = e.extractor)"""
_PCT = "coalesce(round(100.0 * {0} / nullif({1}, 0), 6), 0.0)"


# ---- scans -----------------------------------------------------------------------------------------------------------


@query(f"WITH {A} SELECT id, pmc_id, pmid, doi, title, length(text) AS text_length, journal, pub_year FROM a")
def scan_articles(spark, d):
    return arts(spark, d).select("id", "pmc_id", "pmid", "doi", "title", F.length("text").alias("text_length"), "journal", "pub_year")


@query(f"WITH {A} SELECT id, md5(text) AS text_md5 FROM a")
def scan_narrow(spark, d):
    return arts(spark, d).select("id", F.md5("text").alias("text_md5"))


@query(f"WITH {A} SELECT count(*) AS articles FROM a")
def count_articles(spark, d):
    return arts(spark, d).agg(F.count(F.lit(1)).alias("articles"))


@query("SELECT id, title, length(full_text) AS text_length FROM articles WHERE full_text IS NOT NULL ORDER BY id LIMIT 1")
def text_length(spark, d):
    """One sample row with its length: the limit is the feature."""
    return table(spark, d, "articles").where("full_text is not null").orderBy("id").limit(1).select("id", "title", F.length("full_text").alias("text_length"))


@query(f"WITH {A} SELECT id, left(text, 100) AS preview FROM a")
def text_preview(spark, d):
    return arts(spark, d).select("id", F.left("text", F.lit(100)).alias("preview"))


@query("SELECT min(pub_year) AS first_year, max(pub_year) AS last_year FROM articles")
def year_range(spark, d):
    return table(spark, d, "articles").agg(F.min("pub_year").alias("first_year"), F.max("pub_year").alias("last_year"))


@query("SELECT column_index AS position, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS data_type, is_nullable AS nullable FROM duckdb_columns() WHERE table_name = 'articles'")
def schema_info(spark, d):
    return readers.schema_rows(table(spark, d, "articles"))


@query(f"WITH {A} SELECT s.id, s.run_day, s.rigor_score, length(a.text) AS text_length FROM extraction_scores s JOIN a ON s.id = a.id WHERE s.rigor_score BETWEEN 60 AND 100")
def lookup_join(spark, d):
    """Scored rows with their articles' texts by one equi-join, instead of one lookup a row."""
    s = table(spark, d, "extraction_scores").where(audit.in_band("high")).select("id", "run_day", "rigor_score")
    return s.join(arts(spark, d).select("id", F.length("text").alias("text_length")), "id")


@query("SELECT pmc_id, id, created_at FROM articles WHERE pmc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pmc_id ORDER BY created_at DESC NULLS LAST, id DESC) = 1")
def latest_per_key(spark, d):
    a = table(spark, d, "articles").where("pmc_id is not null").select("pmc_id", "id", "created_at")
    return readers.latest_per_key(a, "pmc_id", "created_at", "id")


_J = "l AS (SELECT line_id, line_text AS t FROM extraction_jsonl WHERE line_text IS NOT NULL AND json_valid(line_text)), o AS (SELECT * FROM l WHERE json_type(t) = 'OBJECT')"


@query(f"WITH {_J} SELECT line_id, CAST(t->>'$.id' AS BIGINT) AS id, t->>'$.metadata.pmc_id' AS pmc_id, t->>'$.metadata.journal' AS journal, t->>'$.error' AS error FROM o")
def scan_jsonl(spark, d):
    """Lines that are one whole object, with what every shape has; errors stay and are told by their column."""
    lines = table(spark, d, "extraction_jsonl").select("line_id", F.try_parse_json("line_text").alias("v")).where("v is not null").where(F.schema_of_variant("v").startswith("OBJECT"))
    g = lambda p, t="string": F.try_variant_get("v", p, t)
    return lines.select("line_id", g("$.id", "long").alias("id"), g("$.metadata.pmc_id").alias("pmc_id"), g("$.metadata.journal").alias("journal"), g("$.error").alias("error"))


@query(
    f"{_P2}, ok AS (SELECT so.rid, so.s FROM so JOIN l USING (rid) WHERE l.t->>'$.error' IS NULL), p AS (SELECT DISTINCT rid FROM item WHERE table_name = 'extraction_jsonl' AND kind = 'p_values')"
    " SELECT count(*) AS results, CAST(sum(CAST(s->>'$.rigor_score' AS INTEGER)) AS BIGINT) AS score_sum, count(*) FILTER (WHERE rid IN (SELECT rid FROM p)) AS with_p FROM ok"
)
def jsonl_results(spark, d):
    """Result lines of the extraction files, wherever their stats sit and also if they are JSON text (errors and malformed lines
    left out): number, scores, lines with p-values."""
    ok = nested.stats_rows(table(spark, d, "extraction_jsonl")).where("error is null and p_values is not null")
    return ok.agg(F.count(F.lit(1)).alias("results"), F.sum("rigor_score").alias("score_sum"), F.count_if(F.col("p_values") > 0).alias("with_p"))


@query("SELECT DISTINCT pmc_id FROM llm_processing_status WHERE lower(trim(status)) = 'completed' AND pmc_id IS NOT NULL")
def completed_ids(spark, d):
    return table(spark, d, "llm_processing_status").where((progress.status_word() == "completed") & F.col("pmc_id").isNotNull()).select("pmc_id").distinct()


@query("SELECT pmc_id FROM llm_processing_status WHERE pmc_id IS NOT NULL UNION SELECT pmc_id FROM llm_article_status WHERE pmc_id IS NOT NULL")
def all_processed(spark, d):
    """Ids that either log has."""
    return progress.all_processed(table(spark, d, "llm_processing_status"), table(spark, d, "llm_article_status"))


@query(f"WITH {A} SELECT id, pmc_id AS m_pmc_id, journal AS m_journal, pub_year AS m_pub_year FROM a")
def metadata_struct(spark, d):
    m = arts(spark, d).select("id", extract.metadata().alias("m"))
    return m.select("id", F.col("m.pmc_id").alias("m_pmc_id"), F.col("m.journal").alias("m_journal"), F.col("m.pub_year").alias("m_pub_year"))


# ---- extraction --------------------------------------------------------------------------------------------------


def _extract_query(c: str):
    sql = f"WITH {A} SELECT id, len(list_distinct({_hits('text', P.IMPLEMENTED[c])})) AS hits FROM a"

    def run(spark, d):
        return spread(arts(spark, d).select("id", "text")).select("id", F.size(extract.distinct_hits(F.col("text"), P.IMPLEMENTED[c])).alias("hits"))

    query(sql, f"extract_{c}")(run)


for _c in P.CATEGORIES:
    _extract_query(_c)


@query(f"WITH {X} " + " UNION ALL ".join(f"SELECT id, '{c}' AS category, unnest({c}) AS match FROM x" for c in P.CATEGORIES))
def extract_long(spark, d):
    return extract.extract_long(extracted(spark, d))


@query(f"WITH {X} SELECT id, rigor_score FROM x")
def rigor_score(spark, d):
    return scores(spark, d).select("id", "rigor_score")


@query(f"WITH {x_sql('documented')} SELECT id, rigor_score FROM x")
def rigor_score_documented(spark, d):
    return scores(spark, d, "documented").select("id", "rigor_score")


_W = "w AS (SELECT id, coalesce(title, '') || ' ' || coalesce(abstract, '') || ' ' || coalesce(body, '') AS text FROM articles)"


@query(f"WITH {_W} SELECT id, " + " + ".join(f"len({_hits('text', [p])})" for p, _ in P.STRUCTURED.values()) + " AS findings FROM w")
def structured_findings_count(spark, d):
    counts = structured.pattern_counts(structured.whole_text())
    return spread(table(spark, d, "articles").select("id", "title", "abstract", "body")).select("id", reduce(lambda a, b: a + b, counts.values()).alias("findings"))


def _whole(spark, d):
    return spread(table(spark, d, "articles").select("id", "title", "abstract", "body"))


@query("WITH " + _W + " SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS pattern, CAST(sum(len({_hits('text', [p])})) AS BIGINT) AS findings FROM w" for n, (p, _) in P.STRUCTURED.items()) + ") WHERE findings > 0")
def structured_findings(spark, d):
    """Findings by pattern, counted where the texts are; structured_places has each with its place."""
    counts = structured.pattern_counts(structured.whole_text())
    one = _whole(spark, d).agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    return one.unpivot([], list(counts), "pattern", "findings").where("findings > 0")


def _places_sql(name: str, pattern: str, kind: str) -> str:
    """Offsets from the lengths of the matches and of what stands between them."""
    m, between = _hits("text", [pattern]), f"string_split_regex(text, {dialect.sql(pattern)})"
    upto = "coalesce(list_sum(list_transform({0}, lambda z: length(z))), 0)"
    return f"""SELECT id, '{name}' AS pattern, '{kind}' AS type, CAST(k - 1 AS INTEGER) AS match_pos, start, m[k] AS raw_text, substring(text, greatest(start - 50, 0) + 1, start + length(m[k]) + 50 - greatest(start - 50, 0)) AS context
    FROM (SELECT *, CAST({upto.format("list_slice(b, 1, k)")} + {upto.format("list_slice(m, 1, k - 1)")} AS BIGINT) AS start FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (SELECT id, text, {m} AS m, {between} AS b FROM w)))"""


@query("WITH " + _W + " " + " UNION ALL ".join(_places_sql(n, p, t) for n, (p, t) in P.STRUCTURED.items()))
def structured_places(spark, d):
    """Every finding with its exact offset and fifty characters of context on either side."""
    return structured.findings(_whole(spark, d)).select("id", "pattern", "type", "match_pos", "start", "raw_text", "context")


def _valid_sql(pattern: str, kind: str) -> str:
    group = lambda i: f"regexp_extract_all(text, {dialect.sql(pattern)}, {i})"
    n = re.compile(pattern).groups
    ok = {"confidence_interval": "TRY_CAST(a AS DOUBLE) < TRY_CAST(b AS DOUBLE)", "p_value": "coalesce(TRY_CAST(b AS DOUBLE) BETWEEN 0 AND 1, true)", "sample_size": "coalesce(TRY_CAST(a AS DOUBLE) > 0, true)"}.get(kind, "true")
    first = 1 if kind == "sample_size" else max(1, n - 1)
    return f"SELECT '{kind}' AS type FROM (SELECT unnest({group(first)}) AS a, unnest({group(n)}) AS b FROM w) WHERE {ok}"


@query("WITH " + _W + " SELECT type, count(*) AS findings FROM (" + " UNION ALL ".join(_valid_sql(p, t) for p, t in P.STRUCTURED.values()) + ") GROUP BY 1")
def structured_valid(spark, d):
    """Structured findings that are possible, by type."""
    return structured.valid_findings(structured.findings(_whole(spark, d))).groupBy("type").agg(F.count(F.lit(1)).alias("findings"))


@query("SELECT id, " + " + ".join(f"len({_hits('body', [p], dotall=True)})" for p in P.TABLE_MARKS) + " AS sections FROM articles WHERE body IS NOT NULL")
def table_section_count(spark, d):
    return table(spark, d, "articles").where("body is not null").select("id", structured.table_section_count(F.col("body")).alias("sections"))


@query("SELECT CAST(sum(n) AS BIGINT) AS sections FROM (SELECT " + " + ".join(f"len({_hits('body', [p], dotall=True)})" for p in P.TABLE_MARKS) + " AS n FROM articles WHERE body <> '')")
def table_sections(spark, d):
    """Table sections with their surroundings, counted."""
    return structured.table_sections(table(spark, d, "articles")).agg(F.count(F.lit(1)).alias("sections"))


@query()
def figure_sections(spark, d):
    return table(spark, d, "articles").select("id", F.size(structured.figure_captions(F.col("body"))).alias("captions"))


# ---- analytics -----------------------------------------------------------------------------------------------------


@query(f"WITH {X} SELECT count(*) AS articles, count(*) FILTER (WHERE rigor_score > 0) AS with_stats, count(*) FILTER (WHERE rigor_score = 0) AS without_stats, {_PCT.format('count(*) FILTER (WHERE rigor_score > 0)', 'count(*)')} AS with_pct FROM x")
def score_totals(spark, d):
    return analytics.score_totals(scores(spark, d))


@query(f"WITH {X} SELECT round(avg(rigor_score), 6) AS mean, median(rigor_score) AS median, round(stddev_pop(rigor_score), 6) AS std, min(rigor_score) AS min, max(rigor_score) AS max FROM x")
def score_moments(spark, d):
    return analytics.score_moments(scores(spark, d))


@query(f"WITH {X} SELECT p AS percentile, s AS score FROM (SELECT unnest([10, 25, 50, 75, 90, 95, 99]) AS p, unnest(quantile_cont(rigor_score, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS s FROM x)")
def score_percentiles(spark, d):
    return analytics.score_percentiles(scores(spark, d))


@query(f"WITH {X} SELECT pub_year, round(avg(rigor_score), 6) AS mean_score, count(*) AS articles FROM x WHERE pub_year BETWEEN 1900 AND 2025 GROUP BY 1 ORDER BY 1 DESC LIMIT 10")
def score_by_year(spark, d):
    return analytics.score_by_year(scores(spark, d))


@query(f"WITH {X} SELECT journal, round(avg(rigor_score), 6) AS mean_score, count(*) AS articles FROM x WHERE journal <> '' GROUP BY 1 HAVING count(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 10")
def top_journals(spark, d):
    """At least 5 articles, as the test tables are small (1,000 by default)."""
    return analytics.top_journals(scores(spark, d), least=5)


@query(f"WITH {X}, n AS (SELECT count(*) AS n FROM x) SELECT category, articles, {_PCT.format('articles', 'n')} AS pct FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS category, count(*) FILTER (WHERE len({c}) > 0) AS articles FROM x" for c in P.CATEGORIES) + "), n")
def category_coverage(spark, d):
    return analytics.category_coverage(spread(arts(spark, d).select("text")).select(*[f.alias(c) for c, f in extract.category_flags().items()]))


@query(f"WITH {X} SELECT rigor_score, count(*) AS articles FROM x GROUP BY 1")
def score_histogram(spark, d):
    return analytics.score_histogram(scores(spark, d))


def _bucket_sql(profile: str, cumulative: bool) -> str:
    values = ", ".join(f"({i}, '{label}', {lo}, {hi})" for i, (label, lo, hi) in enumerate(analytics.BUCKETS[profile]))
    base = f"WITH {X}, b(pos, bucket, lo, hi) AS (VALUES {values}), c AS (SELECT b.pos, b.bucket, count(x.id) AS articles FROM b LEFT JOIN x ON x.rigor_score BETWEEN b.lo AND b.hi GROUP BY 1, 2)"
    run = f", {_PCT.format('sum(articles) OVER (ORDER BY pos)', 'sum(articles) OVER ()')} AS cumulative_pct" if cumulative else ""
    return f"{base} SELECT pos, bucket, articles, {_PCT.format('articles', 'sum(articles) OVER ()')} AS pct{run} FROM c"


@query(_bucket_sql("code", False))
def score_buckets(spark, d):
    return analytics.score_buckets(scores(spark, d)).drop("cumulative_pct")


@query(_bucket_sql("documented", True))
def score_buckets_cumulative(spark, d):
    return analytics.score_buckets(scores(spark, d), "documented")


# ---- predicates and choice ----------------------------------------------------------------------------------------


def _band(name: str):
    lo, hi = audit.BANDS[name]
    query(f"WITH {X} SELECT id, rigor_score FROM x WHERE rigor_score BETWEEN {lo} AND {hi}", f"band_{name}")(lambda spark, d: scores(spark, d).where(audit.in_band(name)).select("id", "rigor_score"))


for _b in audit.BANDS:
    _band(_b)

_RANK = "CASE WHEN contains(body, 'Table') THEN 1 WHEN contains(body, 'Figure') THEN 2 WHEN contains(body, 'CI') OR contains(body, 'confidence interval') THEN 3 ELSE 4 END"


@query(f"SELECT id, {_RANK} AS priority FROM articles")
def priority_rank(spark, d):
    return table(spark, d, "articles").select("id", prioritize.priority_rank().alias("priority"))


@query(f"SELECT id, {_RANK} AS priority, length(coalesce(body, '')) AS body_length FROM articles WHERE pmc_id IS NULL OR pmc_id NOT IN (SELECT pmc_id FROM llm_processing_status WHERE pmc_id IS NOT NULL) ORDER BY 2, pub_year DESC NULLS FIRST, id LIMIT 50")
def priority_page(spark, d):
    """A page of 50: the limit is the feature."""
    return prioritize.priority_page(table(spark, d, "articles"), 50, done=table(spark, d, "llm_processing_status")).select("id", "priority", "body_length")


_JOURNALS = ["Open Annals of Measured Medicine", "Acta Stitokell Studies"]


@query("SELECT id, journal FROM articles WHERE journal IN ('" + "', '".join(_JOURNALS) + "')")
def journal_filter(spark, d):
    return table(spark, d, "articles").where(F.col("journal").isin(*_JOURNALS)).select("id", "journal")


_FL = f"""{X}, fl AS (SELECT a.id, coalesce(contains(a.body, 'Table'), false) AS has_tables, coalesce(contains(a.body, 'Figure') OR contains(a.body, 'Fig'), false) AS has_figures,
  coalesce(len(x.confidence_intervals) > 0, false) AS has_cis, coalesce(x.rigor_score, 0) AS current_score FROM articles a LEFT JOIN x ON a.id = x.id)"""


def _flags(spark, d):
    return prioritize.article_flags(table(spark, d, "articles").select("id", "body"), extracted(spark, d))


@query(f"WITH {_FL} SELECT * FROM fl")
def article_flags(spark, d):
    return _flags(spark, d).drop("body")


@query(f"WITH {_FL} SELECT id, CASE WHEN current_score >= 50 AND NOT has_cis THEN 0 WHEN current_score >= 30 AND NOT has_cis AND (has_tables OR has_figures) THEN 1 WHEN has_tables OR has_figures THEN 2 ELSE 3 END AS llm_priority FROM fl")
def llm_priority(spark, d):
    return _flags(spark, d).select("id", prioritize.llm_priority().alias("llm_priority"))


@query(f"WITH {_FL} SELECT id, CASE WHEN has_tables THEN 'table_focused' WHEN has_figures THEN 'comprehensive' WHEN current_score >= 50 AND NOT has_cis THEN 'ci_focused' ELSE 'comprehensive' END AS prompt FROM fl")
def prompt_choice(spark, d):
    return _flags(spark, d).select("id", prioritize.prompt_choice().alias("prompt"))


@query(f"WITH {X} SELECT id, CASE WHEN rigor_score = 0 THEN 'P1' WHEN rigor_score <= 20 THEN 'P2' WHEN rigor_score <= 30 THEN 'P3' ELSE 'skip' END AS tier FROM x")
def score_tier(spark, d):
    return scores(spark, d).select("id", prioritize.score_tier().alias("tier"))


@query(f"WITH {A} SELECT id, " + " OR ".join(f"contains(lower(left(text, {P.RESEARCH_CHARS})), '{w}')" for w in P.RESEARCH_WORDS) + " AS is_research FROM a")
def is_research(spark, d):
    return arts(spark, d).select("id", prioritize.is_research().alias("is_research"))


@query("SELECT count(*) FILTER (WHERE contains(body, 'Table') OR contains(body, 'Figure')) AS marked FROM articles")
def tables_figures_count(spark, d):
    b = F.col("body")
    return table(spark, d, "articles").agg(F.count_if(F.coalesce(F.contains(b, F.lit("Table")) | F.contains(b, F.lit("Figure")), F.lit(False))).alias("marked"))


_TOK = "(length(coalesce(title, '')) + length(coalesce(abstract, '')) + length(coalesce(body, ''))) // 4"
_LEN = "length(coalesce(body, ''))"
_GK = (
    "array_to_string(list_sort(list_filter(["
    + ", ".join(
        [
            "CASE WHEN contains(c, 'Table') OR contains(c, 'TABLE') THEN 'has_tables' END",
            "CASE WHEN contains(c, 'Figure') OR contains(c, 'FIGURE') THEN 'has_figures' END",
            *[f"CASE WHEN regexp_matches(c, {dialect.sql(p)}) THEN '{n}' END" for n, p in P.CONTENT_FLAGS.items()],
            r"'journal_' || nullif(lower(regexp_extract(coalesce(journal, ''), '^[\s\p{Z}]*([^\s\p{Z}]+)', 1)), '')",
            f"'size_' || CASE WHEN {_LEN} < 10000 THEN 'short' WHEN {_LEN} < 50000 THEN 'medium' WHEN {_LEN} < 100000 THEN 'long' ELSE 'very_long' END",
        ]
    )
    + "], lambda q: q IS NOT NULL)), '_')"
)


@query(f"SELECT id, {_GK} AS group_key FROM (SELECT *, coalesce(body, '') || coalesce(abstract, '') AS c FROM articles)")
def group_key(spark, d):
    return table(spark, d, "articles").select("id", batching.group_key().alias("group_key"))


@query(f"SELECT id, {_TOK} AS tokens FROM articles")
def token_estimate(spark, d):
    return table(spark, d, "articles").select("id", batching.token_estimate().alias("tokens"))


# ---- joins ---------------------------------------------------------------------------------------------------------

_S1 = "s AS (SELECT id, min(rigor_score) AS rigor_score FROM extraction_scores WHERE rigor_score BETWEEN 0 AND 100 GROUP BY id)"


def _one_score(spark, d):
    return table(spark, d, "extraction_scores").where(F.col("rigor_score").between(0, 100)).groupBy("id").agg(F.min("rigor_score").alias("rigor_score"))


@query(f"WITH {_S1} SELECT a.id, s.rigor_score FROM articles a LEFT JOIN s USING (id) WHERE s.rigor_score <= 30 OR s.rigor_score IS NULL")
def low_score_candidates(spark, d):
    return prioritize.low_score_candidates(table(spark, d, "articles").select("id"), _one_score(spark, d), 30)


@query("SELECT id FROM articles WHERE NOT EXISTS (SELECT 1 FROM llm_processing_status p WHERE p.pmc_id = articles.pmc_id)")
def anti_processed(spark, d):
    return extract.unprocessed(table(spark, d, "articles").select("id", "pmc_id"), table(spark, d, "llm_processing_status"), "pmc_id").select("id")


@query("SELECT id FROM articles WHERE pmc_id NOT IN (SELECT pmc_id FROM llm_processing_status)")
def unprocessed(spark, d):
    """NOT IN with its null rule."""
    return prioritize.unprocessed_not_in(table(spark, d, "articles").select("id", "pmc_id"), table(spark, d, "llm_processing_status")).select("id")


@query(f"WITH {FX}, g AS (SELECT pmc_id, count(*) FILTER (WHERE extractor = 'regex') AS regex, count(*) FILTER (WHERE extractor = 'llm') AS llm FROM fx GROUP BY 1) SELECT *, CASE WHEN regex > 0 AND llm > 0 THEN 'both' WHEN llm > 0 THEN 'llm_only' ELSE 'regex_only' END AS joined FROM g")
def merge_join_kind(spark, d):
    return merge.join_kind(fx(spark, d))


_FINDINGS = _P2 + ", found AS (SELECT rid, parent, v FROM item WHERE table_name = 'llm_responses')"


@query(
    f"{_FINDINGS}, n AS (SELECT rid, parent, count(*) AS findings FROM found GROUP BY 1, 2), b AS (SELECT (id - 1) // 5 AS batch, CAST((id - 1) % 5 AS INTEGER) AS pos, pmc_id FROM articles)"
    " SELECT CAST(b.batch AS VARCHAR) AS batch_id, pos, pmc_id, findings FROM b LEFT JOIN n ON b.batch = n.rid AND (n.parent = -1 OR n.parent = b.pos)"
)
def zip_join(spark, d):
    """Articles in batches of five against the answers' articles by position."""
    b = table(spark, d, "articles").select(F.floor((F.col("id") - 1) / 5).cast("string").alias("batch_id"), F.pmod(F.col("id") - 1, F.lit(5)).cast("int").alias("pos"), "pmc_id")
    found = responses.parsed_findings(table(spark, d, "llm_responses")).groupBy(F.col("response_id").cast("string").alias("batch_id"), "article_pos").agg(F.count(F.lit(1)).alias("findings"))
    return responses.answers_to_articles(b, found).select("batch_id", "pos", "pmc_id", "findings")


# ---- progress ------------------------------------------------------------------------------------------------------


@query("SELECT lower(trim(status)) AS status, count(*) AS rows FROM llm_processing_status GROUP BY 1")
def status_counts(spark, d):
    return progress.status_counts(table(spark, d, "llm_processing_status"))


@query("SELECT round(avg(confidence_intervals), 6) AS avg_confidence_intervals, round(avg(p_values), 6) AS avg_p_values, round(avg(sample_sizes), 6) AS avg_sample_sizes FROM llm_article_status")
def merge_quality(spark, d):
    return progress.quality_averages(table(spark, d, "llm_article_status"))


@query("SELECT t AS total, p AS processed, coalesce(round(100.0 * p / nullif(t, 0), 2), 0.0) AS pct FROM (SELECT count(*) AS t FROM articles), (SELECT count(DISTINCT pmc_id) AS p FROM llm_processing_status)")
def percent_complete(spark, d):
    return progress.percent_complete(table(spark, d, "articles"), table(spark, d, "llm_processing_status"))


@query(f"SELECT t AS total, m AS with_tables_figures, p AS processed, t - p AS remaining, {_PCT.format('p', 't')} AS pct FROM (SELECT count(*) AS t, count(*) FILTER (WHERE contains(body, 'Table') OR contains(body, 'Figure')) AS m FROM articles), (SELECT count(DISTINCT pmc_id) AS p FROM llm_processing_status)")
def processing_stats(spark, d):
    return progress.processing_stats(table(spark, d, "articles"), table(spark, d, "llm_processing_status"))


@query("SELECT CAST(coalesce(sum(confidence_intervals), 0) AS BIGINT) AS confidence_intervals, CAST(coalesce(sum(p_values), 0) AS BIGINT) AS p_values, CAST(coalesce(sum(sample_sizes), 0) AS BIGINT) AS sample_sizes, CAST(coalesce(sum(effect_sizes), 0) AS BIGINT) AS effect_sizes, count(*) AS rows FROM llm_article_status WHERE error_message IS NULL")
def extraction_counts(spark, d):
    return progress.extraction_counts(table(spark, d, "llm_article_status"))


@query(
    """WITH b AS (SELECT user_id AS run, event_id AS seq, value AS seconds, row_number() OVER (PARTITION BY user_id ORDER BY event_id) * 10 AS done,
    avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS m FROM events)
    SELECT run, seq, round(m, 9) AS mean_seconds, done, round(ceil(greatest(1000 - done, 0) / 10) * m, 7) AS eta_seconds FROM b"""
)
def eta(spark, d):
    """Events as batches of ten rows, a run per user."""
    b = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), F.col("value").alias("seconds"))
    return progress.eta(b, 1000, 10)


@query("WITH i AS (SELECT user_id % 7 AS instance, count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1) SELECT CAST(coalesce(sum(processed), 0) AS BIGINT) AS processed, CAST(coalesce(sum(errors), 0) AS BIGINT) AS errors, count(*) AS instances, count(*) FILTER (WHERE errors < processed) AS available FROM i")
def fleet_status(spark, d):
    return progress.fleet_status(_fleet(spark, d))


_INST = "i AS (SELECT user_id % 7 AS instance, count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS errors, round(avg(value), 6) AS mean_seconds FROM events GROUP BY 1)"


def _fleet(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 7).alias("instance"), (F.col("event_type") == "error").alias("failed"), F.col("value").alias("seconds"))
    return progress.fleet(e)


@query(f"WITH {_INST} SELECT * FROM i")
def instance_stats(spark, d):
    return _fleet(spark, d)


@query(f"WITH {_INST} SELECT instance, CAST(round(greatest(0.0, 1.0 - least(0.1 * (errors % 4), 0.5) - 0.2 * (instance % 3)), 6) AS DOUBLE) AS score FROM i ORDER BY 2 DESC, 1 LIMIT 1")
def best_instance(spark, d):
    i = _fleet(spark, d).select("instance", (F.col("errors") % 4).alias("errors"), (F.col("instance") % 3).alias("load"))
    return progress.best(i, progress.health_score(), "instance").select("instance", "score")


@query(f"WITH {_INST} SELECT instance, round(0.3 * (100 - coalesce(nullif(instance * 9.0, 27), 50)) + 0.3 * (100 - 50) + 0.4 * mean_seconds, 6) AS score FROM i ORDER BY 2 DESC, 1 LIMIT 1")
def best_worker(spark, d):
    w = _fleet(spark, d).select("instance", F.nullif(F.col("instance") * 9.0, F.lit(27.0)).alias("cpu_percent"), F.lit(None).cast("double").alias("memory_percent"), F.col("mean_seconds").alias("articles_per_minute"))
    return progress.best(w, progress.worker_score(), "instance").select("instance", "score")


@query("SELECT id, (id - 1) % 3 AS instance FROM articles")
def round_robin(spark, d):
    return batching.round_robin(table(spark, d, "articles").select("id", (F.col("id") - 1).alias("r")), "r", 3).select("id", "instance")


@query("WITH s AS (SELECT avg(processing_time) AS s FROM llm_article_status), l(name, most) AS (VALUES ('short', 50), ('medium', 25), ('long', 10), ('very_long', 5)) SELECT name, CAST(CASE WHEN s > 60 THEN greatest(1, floor(most * 0.8)) WHEN s < 20 THEN least(100, floor(most * 1.2)) ELSE most END AS INTEGER) AS most FROM l, s")
def adapt_batch(spark, d):
    limits = spark.createDataFrame([(n, m) for _, n, m in P.SIZE_CLASSES], "name string, most int")
    s = table(spark, d, "llm_article_status").agg(F.avg("processing_time").alias("s"))
    return batching.adapt_limits(limits.crossJoin(F.broadcast(s)), F.col("s")).select("name", "most")  # four rows and one


@query("SELECT id, (row_number() OVER (ORDER BY id) - 1) // 50 AS task FROM articles")
def task_chunks(spark, d):
    return batching.task_chunks(table(spark, d, "articles"))


_PACK = f"""
WITH RECURSIVE k AS (SELECT id, {_LEN} AS len, {_TOK} AS tokens, {_GK} AS group_key FROM (SELECT *, coalesce(body, '') || coalesce(abstract, '') AS c FROM articles)),
a AS (SELECT *, CASE WHEN len < 10000 THEN 50 WHEN len < 50000 THEN 25 WHEN len < 100000 THEN 10 ELSE 5 END AS most, row_number() OVER (PARTITION BY group_key ORDER BY len, (id % 2147483648) * 2654435761 % 4294967296 // 4194304, id) AS rn FROM k),
b AS (SELECT group_key, rn, id, tokens, CAST(0 AS BIGINT) AS batch_no, 0 AS pos, tokens AS total FROM a WHERE rn = 1
  UNION ALL SELECT a.group_key, a.rn, a.id, a.tokens, CASE WHEN b.total + a.tokens > 8000 OR b.pos + 1 >= a.most THEN b.batch_no + 1 ELSE b.batch_no END,
    CASE WHEN b.total + a.tokens > 8000 OR b.pos + 1 >= a.most THEN 0 ELSE b.pos + 1 END, CASE WHEN b.total + a.tokens > 8000 OR b.pos + 1 >= a.most THEN a.tokens ELSE b.total + a.tokens END
  FROM b JOIN a ON a.group_key = b.group_key AND a.rn = b.rn + 1)
SELECT id, group_key, batch_no, pos AS pos_in_batch, tokens FROM b"""


@query(_PACK)
def pack_batches(spark, d):
    return batching.pack_batches(table(spark, d, "articles"))


@query()
def prompt_build(spark, d):
    a = table(spark, d, "articles")
    return batching.prompts(a, batching.pack_batches(a), "Return JSON only.").select("group_key", "batch_no", "part", "articles", F.length("prompt").alias("prompt_length"))


@query()
def llm_prepare(spark, d):
    return batching.llm_prepare(table(spark, d, "articles")).select("id", "piece", F.length("body").alias("body_length"), "table_count", "figure_count", "has_tables", "has_figures")


@query(
    f"{_FINDINGS} SELECT type, location, count(*) AS findings, round(sum(confidence), 6) AS confidence FROM (SELECT coalesce(v->>'$.type', 'other') AS type, coalesce(v->>'$.location', 'unknown') AS location, coalesce(TRY_CAST(v->>'$.confidence' AS DOUBLE), 0.5) AS confidence FROM found) GROUP BY 1, 2"
)
def parse_findings(spark, d):
    return responses.parsed_findings(table(spark, d, "llm_responses")).groupBy("type", "location").agg(F.count(F.lit(1)).alias("findings"), F.round(F.sum("confidence"), 6).alias("confidence"))


@query()
def model_pipeline(spark, d):
    """Batches, prompts, calls (to the offline client), answers and findings, end to end: findings by type."""
    a = table(spark, d, "articles")
    p = batching.prompts(a, batching.pack_batches(a), "Return JSON only.")
    p = p.select(F.xxhash64("group_key", "batch_no", "part").cast("string").alias("batch_id"), "prompt")
    answers = responses.call_model(p, responses.PatternClient).where("status = 'completed'").select(F.col("batch_id").cast("long").alias("response_id"), F.col("answer").alias("payload"))
    return responses.parsed_findings(answers).groupBy("type").agg(F.count(F.lit(1)).alias("findings"))


# ---- validation ----------------------------------------------------------------------------------------------------

_DEC = r"length(regexp_extract(CAST(num AS VARCHAR), '\.(\d+)', 1))"
_RULES = {
    "ci": ("confidence_interval", [("lo IS NULL OR hi IS NULL", "CI: Invalid format"), ("lo >= hi", "CI: Lower bound >= upper bound"), ("NOT (lo > -1000 AND lo < 1000) OR NOT (hi > -1000 AND hi < 1000)", "CI: Unreasonable range"), ("level <> 0 AND level NOT IN (90, 95, 99)", "CI: Unusual confidence level"), ("NOT (hi - lo > 0 AND hi - lo < 100)", "CI: Unusual width")]),
    "p": ("p_value", [("num IS NULL", "P-value: Parsing error"), ("num NOT BETWEEN 0 AND 1", "P-value: Out of range"), (f"{_DEC} > 10", "P-value: Excessive precision"), ("num IN (0, 1)", "P-value: Suspicious value")]),
    "n": ("sample_size", [("num IS NULL", "Sample size: Parsing error"), ("num <= 0", "Sample size: Non-positive value"), ("num >= 10000000", "Sample size: Unreasonable value"), ("num <> floor(num)", "Sample size: Non-integer value")]),
    "effect": ("effect_size", [("name = 'cohens_d' AND num NOT BETWEEN -5 AND 5", "Cohen''s d: Out of range"), ("name = 'correlation' AND num NOT BETWEEN -1 AND 1", "Correlation: Out of range"), ("name = 'r_squared' AND num NOT BETWEEN 0 AND 1", "R-squared: Out of range"), ("name = 'odds_ratio' AND num <= 0", "Odds ratio: Non-positive value")]),
}
_V = FT + ", v AS (" + " UNION ALL ".join(f"SELECT id, pmc_id, '{text}' AS issue FROM f WHERE kind = '{kind}' AND ({cond})" for kind, rules in _RULES.values() for cond, text in rules) + ")"


def _validate(short: str, kind: str):
    sql = f"WITH {FT}, v AS (" + " UNION ALL ".join(f"SELECT '{text}' AS issue, id FROM f WHERE kind = '{kind}' AND ({cond})" for cond, text in _RULES[short][1]) + ") SELECT id, issue FROM v"
    query(sql, f"validate_{short}")(lambda spark, d: validate.validated(fs(spark, d).where(F.col("kind") == kind)).select("id", F.explode("issues").alias("issue")))


for _s, (_k, _) in _RULES.items():
    _validate(_s, _k)

_COMBO = """c AS (SELECT pmc_id, CASE WHEN coalesce(bool_or(kind = 'confidence_interval' AND (j->>'$.lower' IS NOT NULL OR j->>'$.upper' IS NOT NULL) AND lo < 0 AND hi > 0), false) THEN count(*) FILTER (WHERE kind = 'p_value' AND num < 0.05) ELSE 0 END AS significant_with_null,
  CASE WHEN count(num) FILTER (WHERE kind = 'sample_size') > 1 AND max(num) FILTER (WHERE kind = 'sample_size') / nullif(min(num) FILTER (WHERE kind = 'sample_size'), 0) > 1000 THEN 1 ELSE 0 END AS extreme_sizes FROM f GROUP BY 1)"""


@query(f"WITH {FT}, {_COMBO} SELECT * FROM c")
def validate_combo(spark, d):
    return validate.combinations(fs(spark, d))


_VAL = f"""{_V}, {_COMBO}, k AS (SELECT pmc_id, count(*) FILTER (WHERE kind = 'confidence_interval') AS cis, count(*) FILTER (WHERE kind = 'p_value') AS ps, count(*) FILTER (WHERE kind = 'sample_size') AS ns, count(*) FILTER (WHERE kind = 'effect_size') AS effects FROM f GROUP BY 1),
vi AS (SELECT pmc_id, count(*) AS n FROM v GROUP BY 1),
val AS (SELECT *, row_issues + significant_with_null + extreme_sizes + missing_key AS issues FROM (
  SELECT k.*, coalesce(vi.n, 0) AS row_issues, c.significant_with_null, c.extreme_sizes, CASE WHEN coalesce(k.pmc_id, '') = '' THEN 1 ELSE 0 END AS missing_key
  FROM k JOIN c ON k.pmc_id IS NOT DISTINCT FROM c.pmc_id LEFT JOIN vi ON k.pmc_id IS NOT DISTINCT FROM vi.pmc_id))"""


@query(f"WITH {_VAL} SELECT *, issues = 0 AS valid FROM val")
def validate_extraction(spark, d):
    return validate.article_validity(fs(spark, d))


@query(
    f"WITH {_VAL} SELECT pmc_id, round((CASE WHEN issues = 0 THEN 1.0 ELSE greatest(0.3, 1.0 - issues * 0.1) END + (CAST(cis > 0 AS INTEGER) + CAST(ps > 0 AS INTEGER) + CAST(ns > 0 AS INTEGER)) / 3.0"
    " + CASE WHEN cis + ps + ns = 0 THEN 0.2 WHEN cis + ps + ns > 100 THEN 0.7 ELSE least(1.0, (cis + ps + ns) / 20.0) END) / 3.0, 6) AS confidence_score FROM val"
)
def confidence_score(spark, d):
    return validate.confidence_score(validate.article_validity(fs(spark, d))).select("pmc_id", "confidence_score")


@query(f"WITH {_V} SELECT split_part(issue, ':', 1) AS issue, count(*) AS n FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def common_issues(spark, d):
    return validate.common_issues(validate.validated(fs(spark, d)))


@query(f"WITH {_V} SELECT pmc_id, max(id) AS last_id, count(*) AS issues FROM v GROUP BY 1 ORDER BY 2 DESC LIMIT 10")
def recent_errors(spark, d):
    """The last ten articles with issues: the limit is the feature."""
    return validate.recent_errors(validate.validated(fs(spark, d)))


@query(
    f"""WITH {_VAL}, t AS (SELECT count(*) AS validated, count(*) FILTER (WHERE issues = 0) AS valid FROM val), q AS (SELECT *, round(100.0 * valid / nullif(validated, 0), 6) AS rate FROM t),
    b AS (SELECT issue AS top_issue FROM (SELECT split_part(issue, ':', 1) AS issue, count(*) AS n FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1))
    SELECT validated, valid, rate, top_issue, array_to_string(list_filter([CASE WHEN rate < 80 THEN 'high error rate' END, CASE WHEN contains(top_issue, 'CI') THEN 'review CI extraction' END,
      CASE WHEN contains(top_issue, 'P-value') THEN 'review P-value extraction' END, CASE WHEN contains(top_issue, 'Sample size') THEN 'review sample sizes' END, CASE WHEN validated - valid > 100 THEN 'manual review' END], lambda z: z IS NOT NULL), '|') AS recommendations FROM q, b"""
)
def validation_report(spark, d):
    f = fs(spark, d)
    return validate.validation_report(validate.validated(f), validate.article_validity(f))


@query(
    f"""WITH {FX}, e AS (SELECT pmc_id, kind, CASE WHEN kind = 'p_value' THEN round(num, 6) ELSE round(lo, 3) END AS a, CASE WHEN kind = 'p_value' THEN 0 ELSE round(hi, 3) END AS b, bool_or(extractor = 'llm') AS l, bool_or(extractor = 'regex') AS r
      FROM fx WHERE (kind = 'p_value' AND num IS NOT NULL) OR (kind = 'confidence_interval' AND lo IS NOT NULL AND hi IS NOT NULL) GROUP BY 1, 2, 3, 4),
    s AS (SELECT pmc_id, """
    + ", ".join(f"count(*) FILTER (WHERE kind = '{k}' AND {c}) AS {s}_{n}" for k, s in (("confidence_interval", "ci"), ("p_value", "p")) for n, c in (("both", "l AND r"), ("llm_only", "l AND NOT r"), ("regex_only", "r AND NOT l")))
    + """ FROM e GROUP BY 1),
    t AS (SELECT pmc_id, count(*) FILTER (WHERE extractor = 'llm') AS llm_total, count(*) FILTER (WHERE extractor = 'regex') AS regex_total FROM fx GROUP BY 1)
    SELECT t.*, """
    + ", ".join(f"coalesce({s}_{n}, 0) AS {s}_{n}" for s in ("ci", "p") for n in ("both", "llm_only", "regex_only"))
    + ", round((llm_total - regex_total) / greatest(regex_total, 1) * 100, 6) AS improvement_pct FROM t LEFT JOIN s USING (pmc_id)"
)
def compare_sets(spark, d):
    return validate.compare_sets(fx(spark, d))


# ---- merge ---------------------------------------------------------------------------------------------------------

_KEYS = {"ci": ("confidence_interval", "round(lo, 3)", "round(hi, 3)", "{'lo': lo, 'hi': hi}", "abs(y.v.lo - q[1].v.lo) < 0.01 AND abs(y.v.hi - q[1].v.hi) < 0.01"), "p": ("p_value", "round(num, 6)", "0", "{'lo': num, 'hi': num}", "abs(y.v.lo - q[1].v.lo) < 0.0001"), "n": ("sample_size", "floor(num)", "0", "{'lo': num, 'hi': num}", "false")}


def _merge_cte(short: str) -> str:
    kind, k0, k1, v, near = _KEYS[short]
    return f"""d_{short} AS (SELECT pmc_id, extractor, {k0} AS k0, {k1} AS k1, min(id) AS id, arg_min({v}, id) AS v FROM fx WHERE kind = '{kind}' AND {k0} IS NOT NULL AND {k1} IS NOT NULL GROUP BY 1, 2, 3, 4),
l_{short} AS (SELECT pmc_id, coalesce(list({{'id': id, 'k0': k0, 'k1': k1, 'v': v}} ORDER BY id) FILTER (WHERE extractor = 'llm'), []) AS llm, coalesce(list({{'id': id, 'k0': k0, 'k1': k1, 'v': v}} ORDER BY id) FILTER (WHERE extractor = 'regex'), []) AS regex FROM d_{short} GROUP BY 1),
m_{short} AS (SELECT pmc_id, len(llm) AS llm, len(regex) AS regex, list_reduce(list_concat([llm], list_transform(regex, lambda z: [z])), lambda acc, q: CASE WHEN len(list_filter(acc, lambda y: (y.k0 = q[1].k0 AND y.k1 = q[1].k1) OR ({near}))) > 0 THEN acc ELSE list_concat(acc, q) END) AS m FROM l_{short})"""


_EFF = """d_effect AS (SELECT pmc_id, extractor, id, name, num FROM fx WHERE kind = 'effect_size' AND num IS NOT NULL AND name IS NOT NULL),
l_effect AS (SELECT pmc_id, coalesce(list({'id': id, 'name': name, 'num': num} ORDER BY id) FILTER (WHERE extractor = 'llm'), []) AS llm, coalesce(list({'id': id, 'name': name, 'num': num} ORDER BY id) FILTER (WHERE extractor = 'regex'), []) AS regex FROM d_effect GROUP BY 1),
m_effect AS (SELECT pmc_id, len(llm) AS llm, len(regex) AS regex, list_reduce(list_concat([llm], list_transform(regex, lambda z: [z])), lambda acc, q: CASE WHEN len(list_filter(acc, lambda y: y.name = q[1].name AND abs(y.num - q[1].num) < 0.01)) > 0 THEN acc ELSE list_concat(acc, q) END) AS m FROM l_effect)"""
_MERGE = {**{s: _merge_cte(s) for s in _KEYS}, "effect": _EFF}


def _merge(short: str):
    key = "m.name" if short == "effect" else "NULL"
    sql = f"WITH {FX}, {_MERGE[short]}, r AS (SELECT pmc_id, unnest(m) AS m FROM m_{short}) SELECT pmc_id, m.id AS id, CAST({key} AS VARCHAR) AS name, count(*) AS copies FROM r GROUP BY ALL"
    query(sql, f"merge_{short}")(lambda spark, d: merge.MERGES[short][1](fx(spark, d)).groupBy("pmc_id", "id", "name").agg(F.count(F.lit(1)).alias("copies")))


for _s in _MERGE:
    _merge(_s)

_MA = (
    ", ".join(_MERGE.values())
    + """, keys AS (SELECT pmc_id FROM m_ci UNION SELECT pmc_id FROM m_p UNION SELECT pmc_id FROM m_n UNION SELECT pmc_id FROM m_effect),
ma AS (SELECT pmc_id, coalesce(c.regex, 0) + coalesce(p.regex, 0) + coalesce(n.regex, 0) > 0 AS r, coalesce(c.llm, 0) + coalesce(p.llm, 0) + coalesce(n.llm, 0) > 0 AS l,
  coalesce(len(c.m), 0) AS ci, coalesce(len(p.m), 0) AS p, coalesce(len(n.m), 0) AS n, coalesce(len(e.m), 0) AS effect
  FROM keys LEFT JOIN m_ci c USING (pmc_id) LEFT JOIN m_p p USING (pmc_id) LEFT JOIN m_n n USING (pmc_id) LEFT JOIN m_effect e USING (pmc_id))"""
)


@query(f"WITH {FX}, {_MA} SELECT pmc_id, CAST(r AS INTEGER) AS regex_count, CAST(l AS INTEGER) AS llm_count, ci, p, n, effect, ci + p + n + effect AS merged_count FROM ma")
def merge_summary(spark, d):
    return merge.merge_summary(merge.article_counts(_fx_once(spark, d)))


@query(f"WITH {FX}, {_MA} SELECT CASE WHEN r AND l THEN 'both' WHEN l THEN 'llm_only' WHEN r THEN 'regex_only' ELSE 'none' END AS joined, count(*) AS articles, CAST(sum(ci) AS BIGINT) AS ci, CAST(sum(p) AS BIGINT) AS p, CAST(sum(n) AS BIGINT) AS n, CAST(sum(effect) AS BIGINT) AS effect FROM ma GROUP BY 1")
def merge_stats(spark, d):
    return merge.merge_stats(merge.article_counts(_fx_once(spark, d)))


@query(f"WITH {FX} SELECT extractor, kind, count(*) AS findings FROM fx GROUP BY CUBE (extractor, kind)")
def source_matrix(spark, d):
    return merge.source_matrix(fx(spark, d))


@query(
    f"""WITH {FX}, q AS (SELECT *, num IS NOT NULL OR (lo IS NOT NULL AND hi IS NOT NULL) AS read FROM fx),
    g AS (SELECT pmc_id, kind, CASE WHEN read THEN lo + 0.0 END AS lo, CASE WHEN read THEN hi + 0.0 END AS hi, CASE WHEN read THEN num + 0.0 END AS num, CASE WHEN read THEN name END AS name, CASE WHEN NOT read THEN coalesce(context, '') END AS text_key, id, extractor, confidence FROM q)
    SELECT pmc_id, kind, lo, hi, num, name, text_key, id, extractor, round(CASE WHEN extractor = 'llm' THEN confidence ELSE confidence * 0.8 END, 6) AS confidence
    FROM g QUALIFY row_number() OVER (PARTITION BY pmc_id, kind, lo, hi, num, name, text_key ORDER BY CASE WHEN extractor = 'llm' THEN 0 ELSE 1 END, id) = 1"""
)
def merge_findings(spark, d):
    return merge.merge_findings(fx(spark, d))


#: The findings of both records, read in SQL: matched texts of the extraction lines, typed values of the answers.
_T = "CASE WHEN json_type(v) = 'VARCHAR' THEN v->>'$' ELSE v->>'$.match' END"
_NAMES = "CASE q " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ((k.replace("'", "''"), v) for k, v in findings.EFFECT_NAMES.items())) + " ELSE nullif(q, '') END"
_NUM = r"(-?\d+(?:\.\d+)?)"
_BOTH = (
    _P2
    + _P2_VALUES
    + rf""", meta AS (SELECT rid, coalesce(t->>'$.metadata.pmc_id', t->>'$.run.result.metadata.pmc_id') AS pmc_id FROM l),
rx0 AS (SELECT m.pmc_id, rid, parent, pos, CASE kind WHEN 'p_values' THEN 'p_value' WHEN 'sample_sizes' THEN 'sample_size' WHEN 'confidence_intervals' THEN 'confidence_interval' ELSE 'effect_size' END AS kind, {_T} AS t
  FROM item JOIN meta m USING (rid) WHERE table_name = 'extraction_jsonl' AND kind IN ('p_values', 'sample_sizes', 'confidence_intervals', 'effect_sizes') AND m.pmc_id IS NOT NULL),
rx AS (SELECT *, regexp_replace(t, '\d+(?:\.\d+)?\s*%', '', 'g') AS bare, lower(trim(regexp_extract(t, '^([^=:]*)[=:]', 1))) AS q FROM rx0),
lx0 AS (SELECT CASE WHEN parent < 0 THEN r.t->>'$.pmc_id' ELSE json_extract_string(r.t, '$.articles[' || parent || '].pmc_id') END AS pmc_id, ty.*, regexp_replace(regexp_replace(lower(trim(v->>'$.type')), '[\s_-]+', '_', 'g'), 's$', '') AS k0 FROM typed ty JOIN r USING (rid) WHERE table_name = 'llm_responses' AND json_type(v) = 'OBJECT'),
lx AS (SELECT * EXCLUDE k0, CASE k0 WHEN 'ci' THEN 'confidence_interval' ELSE k0 END AS k FROM lx0 WHERE pmc_id IS NOT NULL),
fx AS (SELECT pmc_id, 'regex' AS extractor, {{'a': rid, 'b': parent, 'c': pos}} AS id, kind, CASE WHEN kind = 'effect_size' THEN {_NAMES} END AS name,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(regexp_extract(bare, '{_NUM}\s*(?:,|-|–|to)\s*{_NUM}', 1) AS DOUBLE) END AS lo,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(regexp_extract(bare, '{_NUM}\s*(?:,|-|–|to)\s*{_NUM}', 2) AS DOUBLE) END AS hi,
    CASE WHEN kind = 'confidence_interval' THEN TRY_CAST(regexp_extract(t, '(\d+(?:\.\d+)?)\s*%', 1) AS DOUBLE) END AS level,
    TRY_CAST(CASE kind WHEN 'p_value' THEN regexp_extract(t, '[=<>≤≥]\s*(\d*\.?\d+(?:[eE][-+]?\d+)?)', 1) WHEN 'sample_size' THEN regexp_extract(replace(t, ',', ''), '(\d+)', 1) WHEN 'effect_size' THEN regexp_extract(t, '[=:]\s*(-?\d*\.?\d+)', 1) END AS DOUBLE) AS num FROM rx
  UNION ALL SELECT pmc_id, 'llm', {{'a': rid, 'b': parent, 'c': pos}}, k, CASE WHEN k = 'effect_size' AND json_type(u) = 'OBJECT' AND json_exists(u, '$.type') THEN regexp_replace(lower(u->>'$.type'), '[\s-]+', '_', 'g') END,
    CASE WHEN k = 'confidence_interval' THEN lower END, CASE WHEN k = 'confidence_interval' THEN upper END, CASE WHEN k = 'confidence_interval' THEN level END,
    CASE WHEN k <> 'confidence_interval' THEN TRY_CAST(CASE WHEN json_type(u) = 'OBJECT' THEN CASE WHEN json_exists(u, '$.type') THEN u->>'$.value' END WHEN json_type(u) <> 'ARRAY' THEN u->>'$' END AS DOUBLE) END FROM lx WHERE k IN ('p_value', 'sample_size', 'confidence_interval', 'effect_size'))"""
)


def _records(spark, d):
    return findings.of_both(table(spark, d, "extraction_jsonl"), table(spark, d, "llm_responses"))


@query(f"{_BOTH}, {_MA} SELECT pmc_id, CAST(r AS INTEGER) AS regex_count, CAST(l AS INTEGER) AS llm_count, ci, p, n, effect, ci + p + n + effect AS merged_count FROM ma")
def merge_records(spark, d):
    """Extraction lines and model answers, read, joined by article and merged, end to end: findings of each article by kind."""
    return merge.merge_summary(merge.article_counts(written(_records(spark, d), "record-findings")))


@query(f"{_BOTH} SELECT extractor, kind, count(*) AS findings, count(num) AS numbers, count(lo) AS lows, count(hi) AS highs, count(level) AS levels, count(name) AS names, round(coalesce(sum(num), 0), 4) AS total, round(coalesce(sum(lo) + sum(hi), 0), 4) AS bounds FROM fx GROUP BY 1, 2")
def record_findings(spark, d):
    """What was read from both records, by extractor and kind."""
    n = lambda c, a: F.count(c).alias(a)
    return _records(spark, d).groupBy("extractor", "kind").agg(F.count(F.lit(1)).alias("findings"), n("num", "numbers"), n("lo", "lows"), n("hi", "highs"), n("level", "levels"), n("name", "names"), F.round(F.coalesce(F.sum("num"), F.lit(0.0)), 4).alias("total"), F.round(F.coalesce(F.sum("lo") + F.sum("hi"), F.lit(0.0)), 4).alias("bounds"))


_UP = """t AS (SELECT * FROM llm_article_status WHERE pmc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pmc_id ORDER BY processed_at NULLS FIRST, status, findings_count NULLS FIRST, processing_time NULLS FIRST) = 1),
s AS (SELECT * FROM llm_article_status WHERE pmc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pmc_id ORDER BY processed_at DESC NULLS LAST, status DESC, findings_count DESC NULLS LAST, processing_time DESC NULLS LAST) = 1)"""


def _upsert_inputs(spark, d):
    """The earliest log row of every article as the table, the latest of every article as what comes in."""
    order = ["processed_at", "status", "findings_count", "processing_time"]
    log = table(spark, d, "llm_article_status").where("pmc_id is not null").select("pmc_id", *order)
    first = log.groupBy("pmc_id").agg(F.min(F.struct(*order)).alias("r")).select("pmc_id", "r.*")  # null comes first in a minimum
    return first, readers.latest_per_key(log, "pmc_id", *order)


_UCOLS = ("processed_at", "status", "findings_count", "processing_time")


@query(f"WITH {_UP} SELECT t.pmc_id, " + ", ".join(f"CASE WHEN s.pmc_id IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in _UCOLS) + " FROM t LEFT JOIN s ON t.pmc_id = s.pmc_id")
def upsert_replace(spark, d):
    return sinks.upsert(*_upsert_inputs(spark, d), ["pmc_id"])


@query(f"WITH {_UP} SELECT t.pmc_id, " + ", ".join(f"CASE WHEN s.pmc_id IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in _UCOLS[:2]) + ", t.findings_count, t.processing_time FROM t LEFT JOIN s ON t.pmc_id = s.pmc_id")
def upsert_partial(spark, d):
    return sinks.upsert(*_upsert_inputs(spark, d), ["pmc_id"], ["processed_at", "status"])


# ---- audits, over all articles of a band ---------------------------------------------------------------------------


@query(f"WITH {X} SELECT id, rigor_score FROM x WHERE rigor_score BETWEEN 60 AND 100 ORDER BY (id * 2654435761) % 4294967296, id LIMIT 20")
def sample_band(spark, d):
    """Twenty articles: the limit is the feature."""
    return audit.sample_band(scores(spark, d), "high").select("id", "rigor_score")


_FIVE = audit._FIVE


def _present(text: str) -> str:
    return " + ".join(f"len(list_filter({c}, lambda q: contains({text}, trim(q))))" for c in _FIVE)


_CHK = " + ".join(f"len({c})" for c in _FIVE)
_AH = f"h AS (SELECT id, rigor_score, {_present('text')} AS found, {_CHK} AS checked FROM x WHERE rigor_score BETWEEN 60 AND 100)"


def _of_band(spark, d, band):
    return extracted(spark, d).where(audit.in_band(band))


@query(f"WITH {X}, {_AH} SELECT *, CASE WHEN checked = 0 OR found * 100 >= checked * 80 THEN 'GOOD' ELSE 'NEEDS REVIEW' END AS status FROM h")
def audit_high(spark, d):
    return audit.audit_high(_of_band(spark, d, "high"))


@query(f"WITH {X}, {_AH}, s AS (SELECT count(*) AS articles, CAST(sum(found) AS BIGINT) AS found, CAST(sum(checked) AS BIGINT) AS checked, coalesce(round(100.0 * sum(found) / nullif(sum(checked), 0), 6), 0.0) AS accuracy FROM h) SELECT *, CASE WHEN accuracy >= 90 THEN 'EXCELLENT' WHEN accuracy >= 80 THEN 'GOOD' WHEN accuracy >= 70 THEN 'ACCEPTABLE' ELSE 'NEEDS IMPROVEMENT' END AS grade FROM s")
def audit_summary(spark, d):
    return audit.audit_summary(audit.audit_high(_of_band(spark, d, "high")))


@query(f"WITH {X}, m AS (" + " UNION ALL ".join(f"SELECT id, '{c}' AS category, len({c}) AS extracted, len({_hits('text', P.AUDIT_A[c])}) AS manual FROM x WHERE rigor_score BETWEEN 51 AND 100" for c in P.AUDIT_A if c != "t_tests") + ") SELECT *, abs(extracted - manual) <= 2 AS match FROM m")
def audit_count_match(spark, d):
    return audit.audit_count_match(_of_band(spark, d, "above_50"))


_LOW = f"{X}, m0 AS (" + " UNION ALL ".join(f"SELECT id, '{c}' AS category, len({c}) AS extracted, len(list_distinct(flatten([{', '.join(_hits('text', [p]) for p in ps)}]))) AS found FROM x WHERE rigor_score BETWEEN 1 AND 30" for c, ps in P.AUDIT_B.items()) + "), m AS (SELECT *, greatest(found - extracted, 0) AS missed FROM m0)"


@query(f"WITH {_LOW} SELECT * FROM m")
def audit_low(spark, d):
    return audit.audit_low(_of_band(spark, d, "low"))


_RESEARCH = " OR ".join(f"contains(lower(left(text, {P.RESEARCH_CHARS})), '{w}')" for w in P.RESEARCH_WORDS)


@query(
    f"""WITH {_LOW}, q AS (SELECT id, max(missed) > 0 AS missed FROM m GROUP BY 1), z AS (SELECT q.missed, {_RESEARCH} AS research FROM q JOIN x USING (id)),
    t AS (SELECT count(*) AS articles, count(*) FILTER (WHERE research) AS research, count(*) FILTER (WHERE missed) AS missed, count(*) FILTER (WHERE research AND missed) AS missed_research FROM z),
    c AS (SELECT *, coalesce(round(100.0 * (articles - missed) / nullif(articles, 0), 6), 0.0) AS completeness FROM t)
    SELECT *, CASE WHEN completeness >= 90 THEN 'EXCELLENT' WHEN completeness >= 80 THEN 'GOOD' WHEN completeness >= 70 THEN 'FAIR' ELSE 'NEEDS REVIEW' END AS grade FROM c"""
)
def audit_low_summary(spark, d):
    return audit.audit_low_summary(_of_band(spark, d, "low"))


_MEDIUM = (
    f"{X}, m0 AS (SELECT id, rigor_score, {_present('text')} AS found, {_CHK} AS total, "
    + " + ".join(f"CASE WHEN len(list_distinct({_hits('text', P.AUDIT_C[c])})) > len({c}) * 1.5 THEN 1 ELSE 0 END" for c in _FIVE)
    + " AS missed FROM x WHERE rigor_score BETWEEN 35 AND 50), m AS (SELECT id, rigor_score, found = total AS verified, missed, CASE WHEN found = total AND missed = 0 THEN 'PERFECT' WHEN found = total THEN 'GOOD' WHEN missed = 0 THEN 'PARTIAL' ELSE 'NEEDS REVIEW' END AS status, coalesce(round(100.0 * found / nullif(total, 0), 6), 100.0) AS accuracy FROM m0)"
)


@query(f"WITH {_MEDIUM} SELECT * FROM m")
def audit_medium(spark, d):
    return audit.audit_medium(_of_band(spark, d, "medium"))


@query(
    f"""WITH {_MEDIUM}, t AS (SELECT count(*) AS articles, count(*) FILTER (WHERE status = 'PERFECT') AS perfect, count(*) FILTER (WHERE status = 'GOOD') AS good, count(*) FILTER (WHERE status = 'PARTIAL') AS partial,
    count(*) FILTER (WHERE status = 'NEEDS REVIEW') AS needs_review, coalesce(round(avg(accuracy), 6), 0.0) AS accuracy FROM m) SELECT *, CASE WHEN accuracy >= 90 THEN 'EXCELLENT' WHEN accuracy >= 75 THEN 'GOOD' ELSE 'NEEDS IMPROVEMENT' END AS grade FROM t"""
)
def audit_medium_summary(spark, d):
    return audit.audit_medium_summary(audit.audit_medium(_of_band(spark, d, "medium")))


@query(f"WITH {X}, {_AH.replace('h AS', 'l AS').replace('BETWEEN 60 AND 100', 'BETWEEN 1 AND 30')} SELECT count(*) AS articles, CAST(sum(found) AS BIGINT) AS found, CAST(sum(checked) AS BIGINT) AS checked, coalesce(round(100.0 * sum(found) / nullif(sum(checked), 0), 6), 0.0) AS accuracy, CASE WHEN coalesce(100.0 * sum(found) / nullif(sum(checked), 0), 0) >= 90 THEN 'EXCELLENT' WHEN coalesce(100.0 * sum(found) / nullif(sum(checked), 0), 0) >= 75 THEN 'GOOD' ELSE 'NEEDS IMPROVEMENT' END AS grade FROM l")
def audit_low_presence(spark, d):
    """The presence audit over the low band, graded by the medium scale."""
    return audit.audit_summary(audit.audit_high(_of_band(spark, d, "low")), "medium")


@query(f"WITH {A} SELECT id, length(regexp_replace(coalesce(title, ''), '[^\\x00-\\x7F]', '', 'g')) AS ascii_title, length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS ascii_text FROM a")
def ascii_text(spark, d):
    return arts(spark, d).select("id", F.length(tx.ascii_only(F.col("title"))).alias("ascii_title"), F.length(tx.ascii_only(F.col("text"))).alias("ascii_text"))


@query(
    f"""WITH {X}, m AS (SELECT id, text, unnest(list_slice(list_sort(p_values), 1, 10)) AS item FROM x), k AS (SELECT *, position(item IN text) AS pos FROM m)
    SELECT id, item, pos, CASE WHEN pos > 0 THEN substring(text, greatest(pos - 30, 1), pos + length(item) + 30 - greatest(pos - 30, 1)) END AS context FROM k"""
)
def match_context(spark, d):
    """The first ten p-values of every article with their place and thirty characters around."""
    x = extracted(spark, d).select("id", "text", F.explode(F.slice("p_values", 1, 10)).alias("item"))
    return x.select("id", "item", tx.place(F.col("text"), F.col("item")).alias("pos"), tx.around(F.col("text"), F.col("item")).alias("context"))


@query(f"WITH {_V} SELECT pmc_id, string_agg(issue, '; ' ORDER BY issue, id) AS message, max(n) AS issues FROM (SELECT *, row_number() OVER (PARTITION BY pmc_id ORDER BY issue, id) AS rn, count(*) OVER (PARTITION BY pmc_id) AS n FROM v) WHERE rn <= 3 GROUP BY 1")
def issue_messages(spark, d):
    """Per article with issues, a message of the first three."""
    return validate.issue_messages(validate.validated(fs(spark, d)))


@query(f"WITH {FT} SELECT regexp_replace(lower(trim(statistic_type)), 's+$', '') AS type, count(*) AS rows FROM merged_statistics GROUP BY 1")
def type_singular(spark, d):
    return table(spark, d, "merged_statistics").groupBy(tx.singular(F.lower(F.trim("statistic_type"))).alias("type")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"{_P2} SELECT response_id, len({_hits('payload', P.IMPLEMENTED['confidence_intervals'])}) AS intervals FROM llm_responses WHERE payload IS NOT NULL AND response_id NOT IN (SELECT rid FROM r)")
def raw_interval_hits(spark, d):
    """Answers that hold no whole object, with the intervals their text names."""
    return responses.raw_interval_hits(table(spark, d, "llm_responses")).select("response_id", F.size("intervals").alias("intervals"))


@query(f"WITH {X} SELECT count(*) AS results, CAST(sum(rigor_score) AS BIGINT) AS score_sum, CAST(sum(len(p_values)) AS BIGINT) AS p_values, count(pmc_id) AS with_pmc_id FROM x")
def jsonl_round_trip(spark, d):
    """Extraction written as compressed JSON lines by run and read again."""
    x = extract.extract(spread(arts(spark, d).select("id", *readers.METADATA, "text")))
    path = scratch(spark, "jsonl")
    sinks.write_extraction(extract.output_records(x), path, "run")
    back = readers.results_only(readers.extraction_lines(spark, path))
    return back.agg(F.count(F.lit(1)).alias("results"), F.sum("stats.rigor_score").alias("score_sum"), F.sum(F.size("stats.p_values")).alias("p_values"), F.count("metadata.pmc_id").alias("with_pmc_id"))


@query()
def output_inventory(spark, d):
    """Files and bytes of the newest of two runs' folders."""
    x = extract.extract(spread(arts(spark, d).select("id", *readers.METADATA, "text")))
    path = scratch(spark, "runs")
    for run in ("r1", "r2"):
        sinks.write_extraction(extract.output_records(x), path, run)
    return readers.inventory(spark, path, "*.json*").select(F.regexp_extract("folder", r"[^/]*$", 0).alias("folder"), "files", "bytes")


# ---- streaming -----------------------------------------------------------------------------------------------------


@query(f"WITH {X} SELECT id, rigor_score FROM x")
def stream_extract(spark, d):
    """Articles as a file stream, run to its end, with a checkpoint; the batch extraction must give the same."""
    path = f"{d}/articles.parquet"
    s = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")
    out = scratch(spark, "stream")
    streams.run_available(streams.extraction_stream(s).select("id", "rigor_score"), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("id long, rigor_score int").parquet(f"{out}/rows")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def event_rates(spark, d):
    """The windows of the rate stream, over the table as it is."""
    r = streams.rates(table(spark, d, "events"), width="1 day")
    return r.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events", F.round("value", 4).alias("value"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g) SELECT user_id, min(ts) AS start, count(*) AS beats FROM s GROUP BY user_id, n"""
)
def heartbeat_sessions(spark, d):
    s = streams.heartbeat_sessions(table(spark, d, "events"), gap="1 hour")
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "beats")
