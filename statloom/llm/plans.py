"""Registered queries of the training-text operators and their SQL counterparts."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from statloom.llm import chars, leakage, markup, mixing, packing, quantiles, subjects, survivors
from statloom.runtime import blank, table, written


def _cleaned(spark, d):
    return markup.cleaned(table(spark, d, "articles"))


def p1_found(spark, d):
    return markup.element_rows(_cleaned(spark, d))


def p1_clean(spark, d):
    """Clean text of every article and how many elements it keeps."""
    return _cleaned(spark, d).select("id", "marked", "clean_text", F.size("elements").alias("elements"))


def _p7_tables(spark, d):
    return {"articles": (table(spark, d, "articles"), "id", "full_text"), "merged_statistics": (table(spark, d, "merged_statistics"), "id", "context")}


def p7_found(spark, d):
    return chars.unstable_rows(_p7_tables(spark, d))


def p7_canonical_contexts(spark, d):
    """How many different contexts merged_statistics has before and after all are in one form."""
    t = chars.canonical_text(table(spark, d, "merged_statistics").select("id", "context"), "context")
    return t.agg(F.count_distinct("context").alias("before"), F.count_distinct("canonical").alias("after"), F.sum("segments").alias("segments"))


def p3_found(spark, d):
    scores = table(spark, d, "extraction_scores")
    return quantiles.named(quantiles.shifted_groups(written(quantiles.valid_scores(scores), "valid-scores")), scores)


def _tail(spark, d, qs, high):
    scores = table(spark, d, "extraction_scores")
    by = ["journal_key", "pub_year"]
    s = quantiles.piece_sketches(quantiles.valid_scores(scores), by, "rigor_score", "run_day", high=high)
    return quantiles.named(quantiles.percentiles(s, by, qs, high=high), scores)


def p3_percentiles(spark, d):
    """Median, 90th, 99th and 99.9th percentile of the scores by journal and year, from sketches by run day; the high ranks
    are protected."""
    return _tail(spark, d, [0.5, 0.9, 0.99, 0.999], True)


def p3_low_tail(spark, d):
    """The lowest percentiles likewise, with the low ranks protected."""
    return _tail(spark, d, [0.001, 0.01, 0.1], False)


def _packed(spark, d):
    a = table(spark, d, "articles")
    return packing.pack(a, "id", packing.token_estimate("title", "abstract", "body"))


def p5_found(spark, d):
    a = table(spark, d, "articles")
    with_body = a.where(~blank(F.col("body")))
    packed = packing.pack(with_body, "id", packing.token_estimate("title", "abstract", "body"))
    return packed.where("pieces > 1 and piece = 0").select("id")


def p5_batches(spark, d):
    return _packed(spark, d)


def p5_fill(spark, d):
    return packing.fill_report(_packed(spark, d))


def _mix(spark, d):
    targets = table(spark, d, "mix_targets")
    sized = mixing.sized_documents(table(spark, d, "documents"), targets)
    return sized, mixing.budgets(sized, targets)


def p9_found(spark, d):
    sized, plan = _mix(spark, d)
    return mixing.share_report(mixing.mix(sized, plan), plan).where("short").select("source_name")


def p9_mix(spark, d):
    return mixing.mix(*_mix(spark, d))


def p9_shares(spark, d):
    sized, plan = _mix(spark, d)
    return mixing.share_report(mixing.mix(sized, plan), plan)


def p6_found(spark, d):
    return survivors.best_rows(table(spark, d, "merged_statistics"))


def p6_survivors(spark, d):
    """One record per finding, each field from its best row."""
    return survivors.survivors(table(spark, d, "merged_statistics"))


def p6_judged(spark, d):
    """Every stated location and context with the probability that it is true, by the two-sided quality model."""
    return survivors.judged(table(spark, d, "merged_statistics"))[0]


def p6_quality(spark, d):
    """Sensitivity and specificity of each extractor, by field."""
    return survivors.judged(table(spark, d, "merged_statistics"))[1]


def p8_found(spark, d):
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).where(F.col("run_words") >= leakage.WORDS).select("doc_id", "item_id")


def p8_altered(spark, d):
    """Leaks of stretches of twenty words in which a word may be altered, with how much of the item was aligned."""
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"), words=20, edits=1).where("aligned_words - edits >= 18")


def _subject_model(spark, d):
    return subjects.fit(*(table(spark, d, n) for n in ("documents", "subject_labels", "subjects", "eval_items")))


def p10_found(spark, d):
    return subjects.document_subjects(table(spark, d, "documents"), _subject_model(spark, d)).select("doc_id", "subject_code")


def p10_composition(spark, d):
    """Make-up of the corpus by subject."""
    return subjects.composition(subjects.document_subjects(table(spark, d, "documents"), _subject_model(spark, d)))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p3_found, p3_percentiles, p3_low_tail, p5_found, p5_batches, p5_fill, p6_found, p6_survivors, p6_judged, p6_quality, p7_found, p7_canonical_contexts, p8_found, p8_altered, p9_found, p9_mix, p9_shares, p10_found, p10_composition)}


#: The characters of problem 7 as SQL sees them, as ranges of code points written out here, apart from the operator's own
#: tables: variants of width, style and ligature; invisible characters; spaces.
_VARIANTS = r"\x{aa}\x{ba}\x{132}\x{133}\x{13f}\x{140}\x{149}\x{17f}\x{1c4}-\x{1cc}\x{1f1}-\x{1f3}\x{2100}-\x{2102}\x{2105}-\x{2107}\x{210a}-\x{2113}\x{2115}\x{2116}\x{2119}-\x{211d}\x{2121}\x{2124}\x{2128}\x{212c}\x{212d}\x{212f}-\x{2131}\x{2133}-\x{2139}\x{213b}-\x{2140}\x{2145}-\x{2149}\x{2160}-\x{217f}\x{2460}-\x{24ea}\x{3131}-\x{318e}\x{3200}-\x{32fe}\x{3300}-\x{33ff}\x{fb00}-\x{fb06}\x{fb13}-\x{fb17}\x{fb20}-\x{fb29}\x{fb4f}-\x{fdfb}\x{fe70}-\x{fefc}\x{ff01}-\x{ff9f}\x{ffa1}-\x{ffee}\x{1d400}-\x{1d7ff}\x{1ee00}-\x{1eebb}\x{1f100}-\x{1f10a}\x{1f110}-\x{1f12e}\x{1f130}-\x{1f14f}"
_HIDDEN = r"\x{1}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}-\x{84}\x{86}-\x{9f}\x{ad}\x{34f}\x{600}-\x{605}\x{61c}\x{6dd}\x{70f}\x{115f}\x{1160}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{2066}-\x{206f}\x{3164}\x{fe00}-\x{fe0f}\x{feff}\x{ffa0}\x{fff9}-\x{fffb}\x{e0001}\x{e0020}-\x{e007f}"
_SPACES = r"\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
_OTHER = r"[\p{Cyrillic}\x{370}-\x{3a8}\x{3aa}-\x{3bb}\x{3bd}-\x{3ff}\x{1f00}-\x{1fff}\p{Armenian}\p{Cherokee}\p{Coptic}]"
_UNSTABLE = rf"[{_VARIANTS}{_HIDDEN}{_SPACES}]|[A-Za-z\p{{Greek}}][\x{{300}}-\x{{304}}\x{{306}}-\x{{30c}}]|\p{{Latin}}{_OTHER}|{_OTHER}\p{{Latin}}"
_P7 = f"""SELECT 'articles' AS table_name, id AS row_id FROM articles WHERE regexp_matches(full_text, '{_UNSTABLE}')
UNION ALL SELECT 'merged_statistics', id FROM merged_statistics WHERE regexp_matches(context, '{_UNSTABLE}')"""


def _plain_sql(text: str) -> str:
    """A text in one form, for SQL: the plain characters come from the standard library's compatibility mapping."""
    one: dict[str, str] = {}
    for lo, hi in ((0x2100, 0x214F), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF)):
        for p in range(lo, hi + 1):
            plain = unicodedata.normalize("NFKC", chr(p))
            if len(plain) == 1 and plain != chr(p) and plain not in "'":
                one[chr(p)] = plain
    wide = f"translate({text}, '{''.join(one)}', '{''.join(one.values())}')"
    for ligature, letters in zip("ﬀﬁﬂﬃﬄﬅﬆ", ("ff", "fi", "fl", "ffi", "ffl", "st", "st"), strict=True):
        wide = f"replace({wide}, '{ligature}', '{letters}')"
    return f"nfc_normalize(regexp_replace(regexp_replace({wide}, '[{_HIDDEN}]', '', 'g'), '[{_SPACES}]', ' ', 'g'))"


#: Look-alikes in Latin words, as the test data has them.
_CYRILLIC, _LATIN = "асеорхуіјѕһкмтвнАВСЕНІКМОРТХο", "aceopxyijshkmtbhABCEHIKMOPTXo"
_P8 = rf"""
WITH t AS (SELECT 'd' AS side, doc_id AS id, text AS txt FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'i', item_id, passage FROM eval_items WHERE passage IS NOT NULL),
n AS (SELECT side, id, regexp_replace({_plain_sql("txt")}, '</?[A-Za-z][^<>]*>|<!--|-->|&#?[A-Za-z0-9]{{1,8}};|\\[A-Za-z]+\*?', ' ', 'g') AS txt FROM t),
w AS (SELECT side, id, list_filter(regexp_split_to_array(txt, '[^\p{{L}}\p{{Nd}}]+'), lambda x: x <> '') AS ws FROM n),
m AS (SELECT side, id, list_transform(ws, lambda x: lower(CASE WHEN regexp_matches(x, '\p{{Latin}}') THEN translate(x, '{_CYRILLIC}', '{_LATIN}') ELSE x END)) AS ws FROM w),
g AS (SELECT side, id, hash(array_to_string(list_slice(ws, k, k + 12), ' ')) AS h FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS k FROM m WHERE len(ws) >= 13))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i ON d.h = i.h WHERE d.side = 'd' AND i.side = 'i'
"""
_P3 = """
WITH v AS (SELECT id, min_by(journal, scored_at) AS journal, min_by(pub_year, scored_at) AS pub_year, min_by(rigor_score, scored_at) AS s
  FROM extraction_scores WHERE journal IS NOT NULL AND pub_year BETWEEN 1900 AND 2025 AND rigor_score BETWEEN 0 AND 100 GROUP BY id),
j AS (SELECT journal, median(s) AS m FROM v GROUP BY 1),
g AS (SELECT journal, pub_year, median(s) AS m, count(*) AS n FROM v GROUP BY 1, 2)
SELECT g.journal, g.pub_year FROM g JOIN j USING (journal) WHERE g.n >= 30 AND abs(g.m - j.m) >= 20
"""
_P5 = """
SELECT id FROM articles WHERE regexp_matches(body, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]')
AND (coalesce(length(title), 0) + coalesce(length(abstract), 0) + coalesce(length(body), 0)) // 4 > 8000
"""
_P6 = """
WITH p AS (SELECT *, regexp_replace(regexp_replace(lower(trim(statistic_type)), '[\\s_-]+', '_', 'g'), 's$', '') AS t,
    CASE WHEN json_valid(value) THEN value END AS j, lower(trim(source)) AS s FROM merged_statistics WHERE pmc_id IS NOT NULL),
k AS (SELECT *,
    CASE WHEN t = 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.lower', j->>'$.value.lower', j->>'$[0]', j->>'$.value[0]') AS DOUBLE) END AS lo,
    CASE WHEN t = 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.upper', j->>'$.value.upper', j->>'$[1]', j->>'$.value[1]') AS DOUBLE) END AS hi,
    CASE WHEN t <> 'confidence_interval' THEN TRY_CAST(coalesce(j->>'$.value', j->>'$') AS DOUBLE) END AS num,
    CASE WHEN t = 'effect_size' THEN regexp_replace(lower(j->>'$.type'), '[\\s_-]+', '', 'g') END AS nm,
    CASE s WHEN 'both' THEN 0 WHEN 'llm' THEN 1 WHEN 'regex' THEN 2 ELSE 3 END AS rk FROM p),
g AS (SELECT *, min(id) OVER w AS group_id, count(*) OVER w AS n FROM k
    WHERE (t = 'confidence_interval' AND lo IS NOT NULL AND hi IS NOT NULL) OR (t <> 'confidence_interval' AND num IS NOT NULL AND (t <> 'effect_size' OR nm IS NOT NULL))
    WINDOW w AS (PARTITION BY pmc_id, t, lo, hi, num, nm)),
f AS (SELECT group_id, 'source' AS field, id, rk, created_at, 0 AS cut FROM g WHERE n > 1 AND trim(source) <> '' AND s NOT IN ('n/a', 'unknown', '-', 'null', 'none')
  UNION ALL SELECT group_id, 'context', id, rk, created_at, CASE WHEN regexp_matches(trim(context), '(\\.\\.\\.|\\[\\.\\.\\.\\])$') THEN 1 ELSE 0 END FROM g WHERE n > 1 AND trim(context) <> '' AND lower(trim(context)) NOT IN ('n/a', 'unknown', '-', 'null', 'none')
  UNION ALL SELECT group_id, 'location', id, rk, created_at, 0 FROM g WHERE n > 1 AND trim(location) <> '' AND lower(trim(location)) NOT IN ('n/a', 'unknown', '-', 'null', 'none')
  UNION ALL SELECT group_id, 'confidence', id, rk, created_at, 0 FROM g WHERE n > 1 AND confidence BETWEEN 0 AND 1)
SELECT group_id, field, id AS from_id FROM f QUALIFY row_number() OVER (PARTITION BY group_id, field ORDER BY cut, rk, created_at DESC NULLS LAST, id DESC) = 1
"""
_P6_SURVIVORS = f"""
WITH best AS ({_P6}) SELECT group_id, max(CASE WHEN field = 'source' THEN m.source END) AS source, max(CASE WHEN field = 'context' THEN m.context END) AS context, max(CASE WHEN field = 'location' THEN m.location END) AS location, max(CASE WHEN field = 'confidence' THEN m.confidence END) AS confidence
FROM best JOIN merged_statistics m ON m.id = best.from_id GROUP BY 1
"""
#: Characters stand in for tokens: which sources stay short is the same by any usual tokenizer.
_P9 = """
WITH d AS (SELECT regexp_replace(lower(trim(source)), '[\\s_-]+', '-', 'g') AS source_name, coalesce(length(text), 0) AS n FROM documents),
t AS (SELECT regexp_replace(lower(trim(source_name)), '[\\s_-]+', '-', 'g') AS source_name, sum(weight) AS weight, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY 1),
h AS (SELECT t.source_name, weight, max_repeats, coalesce(sum(n), 0) AS n FROM t LEFT JOIN d USING (source_name) GROUP BY ALL)
SELECT source_name FROM h WHERE n * max_repeats < weight * (SELECT sum(n) FROM h)
"""
ORACLES = {"p9_found": _P9, "p6_found": _P6, "p6_survivors": _P6_SURVIVORS, "p3_found": _P3, "p5_found": _P5, "p7_found": _P7, "p8_found": _P8}
