"""Registered queries of the general data operators: nested records and incremental processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import incremental as inc
from statloom.operators import nested
from statloom.runtime import scratch, strip, table


def _items(spark, d):
    return nested.all_items({n: table(spark, d, n) for n in nested.SOURCES})


def p2_found(spark, d):
    return _items(spark, d).select("table_name", "record_id", "parent_pos", "kind", "item_pos")


def p2_intervals(spark, d):
    """The intervals' own table, of all three sources: bounds and level typed, keys and parent links kept."""
    return nested.variant_table(_items(spark, d), "intervals")


def p2_numbers(spark, d):
    """The table of single numbers: p-values, sample sizes and effects stated as numbers."""
    return nested.variant_table(_items(spark, d), "numbers")


def p2_matches(spark, d):
    """The table of matched texts."""
    return nested.variant_table(_items(spark, d), "matches")


def p2_others(spark, d):
    """The table of what fits no other subtype, as JSON."""
    return nested.variant_table(_items(spark, d), "others")


def p2_shape_counts(spark, d):
    """How many items each source has of each kind and variant."""
    return _items(spark, d).groupBy("table_name", "kind", "variant").agg(F.count(F.lit(1)).alias("items"))


def p4_found(spark, d):
    return inc.due_articles(spark, table(spark, d, "articles"), table(spark, d, "llm_processing_status"), table(spark, d, "llm_article_status"), scratch(spark, "p4-state"))


def p4_next_run(spark, d):
    """What a second run still has to do after one run in which the articles failed that have failed before (rows of status
    failed in llm_article_status, whenever): those alone."""
    status = table(spark, d, "llm_article_status")
    run, versions = inc.due_run(spark, table(spark, d, "articles"), table(spark, d, "llm_processing_status"), status, scratch(spark, "p4-runs"))
    ever = status.where(F.lower(strip(F.col("status"))) == "failed").select(inc.spelled(F.col("pmc_id")).alias("key")).distinct()
    run.commit(run.due.join(ever, "key", "left_anti"), run.due.join(ever, "key", "left_semi"))
    return inc.begin(run.store, inc.keyed_hashes(versions)).due.select(F.col("key").alias("pmc_id"))


QUERIES = {f.__name__: f for f in (p2_found, p2_intervals, p2_numbers, p2_matches, p2_others, p2_shape_counts, p4_found, p4_next_run)}

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_P4 = rf"""
changed AS (
  SELECT upper(regexp_replace(pmc_id, '{_WS}+', '', 'g')) AS pmc_id, max(greatest(created_at, updated_at)) AS changed
  FROM articles WHERE body IS NOT NULL AND regexp_matches(body, '[^\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]') AND pmc_id IS NOT NULL GROUP BY 1),
done AS (
  SELECT upper(regexp_replace(pmc_id, '{_WS}+', '', 'g')) AS pmc_id, max(processed_at) AS done
  FROM llm_processing_status WHERE lower(trim(status)) = 'completed' GROUP BY 1),
failed AS (
  SELECT upper(regexp_replace(pmc_id, '{_WS}+', '', 'g')) AS pmc_id, max(processed_at) AS failed
  FROM llm_article_status WHERE lower(trim(status)) = 'failed' GROUP BY 1),
due AS (
  SELECT c.pmc_id FROM changed c LEFT JOIN done d USING (pmc_id) LEFT JOIN failed f USING (pmc_id)
  WHERE c.pmc_id <> '' AND (d.done IS NULL OR c.changed > d.done OR f.failed >= d.done))
"""
_CATS = ", ".join(f"'{c}'" for c in nested.CATEGORIES)
_ITEMS = "CASE WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END"
#: Lists unnested with their positions; null entries count as places but are no items.
_P2 = f"""
WITH l AS (SELECT line_id AS rid, CAST(line_text AS JSON) AS t FROM extraction_jsonl WHERE json_valid(line_text) AND json_type(line_text) = 'OBJECT'),
s0 AS (SELECT rid, coalesce(json_extract(t, '$.stats'), json_extract(t, '$.run.result.stats')) AS s FROM l),
s AS (SELECT rid, CASE WHEN json_type(s) = 'VARCHAR' THEN CASE WHEN json_valid(s->>'$') THEN CAST(s->>'$' AS JSON) END ELSE s END AS s FROM s0),
so AS (SELECT * FROM s WHERE json_type(s) = 'OBJECT'),
sa AS (SELECT rid, json_extract(s, '$.sections[*]') AS a FROM so),
h AS (SELECT rid, -1 AS parent, s AS h FROM so UNION ALL SELECT rid, i - 1, a[i] FROM (SELECT rid, a, unnest(range(1, len(a) + 1)) AS i FROM sa)),
c AS (SELECT rid, parent, cat, json_extract(h, '$.' || cat) AS v FROM h, (SELECT unnest([{_CATS}]) AS cat) WHERE json_type(h) = 'OBJECT'),
j AS (SELECT 'extraction_jsonl' AS table_name, rid, parent, cat AS kind, {_ITEMS} AS a FROM c WHERE v IS NOT NULL),
r0 AS (SELECT response_id AS rid, regexp_extract(payload, '(?s)(\\{{.*\\}})', 1) AS t FROM llm_responses WHERE contains(payload, '{{')),
r AS (SELECT rid, CAST(t AS JSON) AS t FROM r0 WHERE t <> '' AND json_valid(t)),
ra AS (SELECT rid, json_extract(t, '$.articles[*]') AS a FROM r),
rh AS (SELECT rid, -1 AS parent, t AS h FROM r UNION ALL SELECT rid, i - 1, a[i] FROM (SELECT rid, a, unnest(range(1, len(a) + 1)) AS i FROM ra)),
f AS (SELECT 'llm_responses' AS table_name, rid, parent, 'finding' AS kind, {_ITEMS} AS a FROM (SELECT rid, parent, json_extract(h, '$.findings') AS v FROM rh WHERE json_type(h) = 'OBJECT') WHERE v IS NOT NULL),
x0 AS (SELECT id AS rid, CAST(confidence_intervals AS JSON) AS v FROM llm_extracted_stats WHERE json_valid(confidence_intervals)),
x1 AS (SELECT rid, CASE WHEN json_type(v) = 'OBJECT' OR json_type(v, '$[0]') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN [v] ELSE json_extract(v, '$[*]') END AS a FROM x0 WHERE json_type(v) IN ('OBJECT', 'ARRAY')),
xg AS (SELECT rid, i - 1 AS parent, json_extract(a[i], '$.intervals') AS v FROM (SELECT rid, a, unnest(range(1, len(a) + 1)) AS i FROM x1) WHERE json_exists(a[i], '$.table')),
x AS (SELECT 'llm_extracted_stats' AS table_name, rid, -1 AS parent, 'confidence_intervals' AS kind, list_transform(a, lambda q: CASE WHEN json_exists(q, '$.table') THEN CAST('null' AS JSON) ELSE q END) AS a FROM x1
  UNION ALL SELECT 'llm_extracted_stats', rid, parent, 'confidence_intervals', {_ITEMS} FROM xg WHERE v IS NOT NULL),
e AS (SELECT * FROM j UNION ALL SELECT * FROM f UNION ALL SELECT * FROM x),
item AS (SELECT table_name, rid, CAST(parent AS INTEGER) AS parent, kind, CAST(i - 1 AS INTEGER) AS pos, a[i] AS v FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM e) WHERE json_type(a[i]) <> 'NULL')
"""
_P2_FOUND = """
SELECT table_name, rid AS record_id, parent AS parent_pos, kind, pos AS item_pos FROM item
"""
#: What an item's value is, unwrapped from {"value": ...} as long as that leads to an interval or a number.
_NUMERIC = "(json_type({0}) IN ('DOUBLE', 'BIGINT', 'UBIGINT') OR json_type({0}) = 'VARCHAR' AND TRY_CAST({0}->>'$' AS DOUBLE) IS NOT NULL)"
_WRAPPED = "json_type({0}) = 'OBJECT' AND NOT (json_exists({0}, '$.lower') AND json_exists({0}, '$.upper')) AND NOT json_exists({0}, '$.match') AND NOT json_exists({0}, '$.type') AND json_exists({0}, '$.value')"
_BOXED = "json_type({0}) = 'OBJECT' AND json_exists({0}, '$.value') AND json_type({0}, '$.value') IN ('OBJECT', 'ARRAY') AND NOT (json_exists({0}, '$.lower') AND json_exists({0}, '$.upper'))"
_P2_VALUES = f"""
, u0 AS (SELECT *, CASE WHEN kind = 'finding' AND json_type(v) = 'OBJECT' THEN json_extract(v, '$.value') ELSE v END AS u FROM item),
u1 AS (SELECT * EXCLUDE u, CASE WHEN {_WRAPPED.format("u")} OR {_BOXED.format("u")} THEN json_extract(u, '$.value') ELSE u END AS u FROM u0),
u2 AS (SELECT * EXCLUDE u, CASE WHEN {_WRAPPED.format("u")} OR {_BOXED.format("u")} THEN json_extract(u, '$.value') ELSE u END AS u FROM u1),
u AS (SELECT *, json_type(u) = 'OBJECT' AND json_exists(u, '$.lower') AND json_exists(u, '$.upper') AS named,
  json_type(u) = 'ARRAY' AND json_array_length(u) BETWEEN 2 AND 3 AND {_NUMERIC.format("json_extract(u, '$[0]')")} AND {_NUMERIC.format("json_extract(u, '$[1]')")} AND (json_array_length(u) = 2 OR {_NUMERIC.format("json_extract(u, '$[2]')")}) AS pair FROM u2),
typed AS (SELECT *, TRY_CAST(CASE WHEN named THEN u->>'$.lower' WHEN pair THEN u->>'$[0]' END AS DOUBLE) AS lower, TRY_CAST(CASE WHEN named THEN u->>'$.upper' WHEN pair THEN u->>'$[1]' END AS DOUBLE) AS upper,
  TRY_CAST(CASE WHEN named THEN u->>'$.level' WHEN pair THEN u->>'$[2]' END AS DOUBLE) AS level FROM u)
"""
_KEYS = "SELECT table_name, rid AS record_id, parent AS parent_pos, kind, pos AS item_pos, "
ORACLES = {
    "p2_found": _P2 + _P2_FOUND,
    "p2_intervals": _P2 + _P2_VALUES + _KEYS + "lower, upper, level FROM typed WHERE named OR pair",
    "p2_numbers": _P2 + _P2_VALUES + _KEYS + f"""TRY_CAST(CASE WHEN effect THEN u->>'$.value' ELSE u->>'$' END AS DOUBLE) AS number, CASE WHEN effect THEN u->>'$.type' WHEN json_type(u) = 'VARCHAR' THEN u->>'$' END AS text
FROM (SELECT *, json_type(u) = 'OBJECT' AND json_exists(u, '$.type') AND {_NUMERIC.format("json_extract(u, '$.value')")} AS effect FROM typed) WHERE effect OR {_NUMERIC.format("u")}""",
    "p2_matches": _P2 + _P2_VALUES + _KEYS + f"CASE WHEN json_type(u) = 'VARCHAR' THEN u->>'$' WHEN json_type(u, '$.match') = 'VARCHAR' THEN u->>'$.match' END AS text FROM typed WHERE json_type(u) = 'VARCHAR' AND NOT {_NUMERIC.format('u')} OR json_type(u) = 'OBJECT' AND NOT named AND json_exists(u, '$.match')",
    "p4_found": f"WITH {_P4} SELECT pmc_id FROM due",
    "p4_next_run": f"WITH {_P4} SELECT pmc_id FROM due WHERE pmc_id IN (SELECT pmc_id FROM failed)",
}
