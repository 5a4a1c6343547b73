"""Validation of findings. Rules are row-wise; what concerns a whole article is aggregated, never gathered in lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the rules and the labels their issues begin with.
LIMITS = {"ci_bound": 1000.0, "ci_width": 100.0, "levels": (90.0, 95.0, 99.0), "p_decimals": 10, "n_most": 10_000_000, "p_significant": 0.05, "n_ratio": 1000.0}
EFFECTS = {"cohens_d": ("Cohen's d", -5.0, 5.0), "correlation": ("Correlation", -1.0, 1.0), "r_squared": ("R-squared", 0.0, 1.0)}


def _all(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for bad, text in rules]))


def issues() -> Column:
    """Issue texts of one typed finding; an empty list if it is in order."""
    lo, hi, level, num = F.col("lo"), F.col("hi"), F.col("level"), F.col("num")
    b = LIMITS["ci_bound"]
    outside = lambda c: ~((c > -b) & (c < b))
    ci = _all(
        (lo.isNull() | hi.isNull(), "CI: Invalid format"),
        (lo >= hi, "CI: Lower bound >= upper bound"),
        (outside(lo) | outside(hi), "CI: Unreasonable range"),
        ((level != 0) & ~level.isin(*LIMITS["levels"]), "CI: Unusual confidence level"),
        (~((hi - lo > 0) & (hi - lo < LIMITS["ci_width"])), "CI: Unusual width"),
    )
    decimals = F.length(F.regexp_extract(num.cast("string"), r"\.(\d+)", 1))
    p = _all((num.isNull(), "P-value: Parsing error"), (~num.between(0, 1), "P-value: Out of range"), (decimals > LIMITS["p_decimals"], "P-value: Excessive precision"), (num.isin(0.0, 1.0), "P-value: Suspicious value"))
    n = _all((num.isNull(), "Sample size: Parsing error"), (num <= 0, "Sample size: Non-positive value"), (num >= LIMITS["n_most"], "Sample size: Unreasonable value"), (num != F.floor(num), "Sample size: Non-integer value"))
    e = _all(
        *[((F.col("name") == k) & ~num.between(lo_, hi_), f"{label}: Out of range") for k, (label, lo_, hi_) in EFFECTS.items()],
        ((F.col("name") == "odds_ratio") & (num <= 0), "Odds ratio: Non-positive value"),
    )
    none = F.array().cast("array<string>")
    k = F.col("kind")
    return F.when(k == "confidence_interval", ci).when(k == "p_value", p).when(k == "sample_size", n).when(k == "effect_size", e).otherwise(none)


def validated(f: DataFrame) -> DataFrame:
    return f.withColumn("issues", issues())


def _combined() -> dict[str, Column]:
    """Aggregates behind the rules on combinations. Only intervals written as an object with bounds count."""
    k = F.col("kind")
    size = F.when(k == "sample_size", F.col("num"))
    return {
        "sig": F.count_if((k == "p_value") & (F.col("num") < LIMITS["p_significant"])),
        "null_ci": F.coalesce(F.max((k == "confidence_interval") & F.col("bounded") & (F.col("lo") < 0) & (F.col("hi") > 0)), F.lit(False)),
        "sizes": F.count(size),
        "most": F.max(size),
        "least": F.min(size),
    }


def _combination_issues() -> dict[str, Column]:
    extreme = (F.col("sizes") > 1) & (F.try_divide("most", "least") > LIMITS["n_ratio"])
    return {"significant_with_null": F.when(F.col("null_ci"), F.col("sig")).otherwise(F.lit(0)), "extreme_sizes": F.when(extreme, 1).otherwise(0)}


def combinations(f: DataFrame, key: str = "pmc_id") -> DataFrame:
    """Per article: one issue for each significant p-value where some interval holds zero, and one where sample sizes
    differ over a thousandfold. A smallest size of 0 gives no ratio."""
    per = f.groupBy(key).agg(*[c.alias(n) for n, c in _combined().items()])
    return per.select(key, *[c.alias(n) for n, c in _combination_issues().items()])


def article_validity(f: DataFrame, key: str = "pmc_id") -> DataFrame:
    """Per article: findings by kind, number of issues (rows, combinations, a missing key), valid if there are none. One
    aggregation; findings of no article are one group."""
    k = F.col("kind")
    kinds = {"cis": "confidence_interval", "ps": "p_value", "ns": "sample_size", "effects": "effect_size"}
    per = validated(f).groupBy(key).agg(*[F.count_if(k == kind).alias(n) for n, kind in kinds.items()], F.sum(F.size("issues")).alias("row_issues"), *[c.alias(n) for n, c in _combined().items()])
    missing = F.coalesce(F.col(key) == "", F.lit(True)).cast("int").alias("missing_key")
    j = per.select(key, *kinds, "row_issues", *[c.alias(n) for n, c in _combination_issues().items()], missing)
    total = F.col("row_issues") + F.col("significant_with_null") + F.col("extreme_sizes") + F.col("missing_key")
    return j.withColumn("issues", total).withColumn("valid", F.col("issues") == 0)


def confidence_score(validity: DataFrame) -> DataFrame:
    """Mean of validity, completeness and count scores."""
    found = F.col("cis") + F.col("ps") + F.col("ns")
    base = F.when(F.col("valid"), 1.0).otherwise(F.greatest(F.lit(0.3), 1.0 - F.col("issues") * 0.1))
    complete = sum(((F.col(c) > 0).cast("int") for c in ("cis", "ps", "ns")), F.lit(0)) / 3.0
    count = F.when(found == 0, 0.2).when(found > 100, 0.7).otherwise(F.least(F.lit(1.0), found / 20.0))
    return validity.withColumn("confidence_score", F.round((base + complete + count) / 3.0, 6))


def common_issues(v: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent issue labels (what stands before the first colon). The limit is the feature."""
    return v.select(F.explode("issues").alias("i")).groupBy(F.split("i", ":")[0].alias("issue")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issue").limit(top)


def issue_messages(v: DataFrame, key: str = "pmc_id", first: int = 3) -> DataFrame:
    """Per key with issues: the first of them (by text, then id) as one message, and their number. Each task keeps only the
    first few of a key: the three smallest are made by rank within salted parts, then within the key."""
    i = v.select(key, "id", F.explode("issues").alias("issue"))
    salted = Window.partitionBy(key, F.pmod("id", F.lit(16))).orderBy("issue", "id")
    few = i.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= first).drop("_r")
    top = few.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct("issue", "id"))), 1, first).alias("t"))  # at most 16 * first a key
    n = i.groupBy(F.col(key).alias("_of")).agg(F.count(F.lit(1)).alias("issues"))
    return top.join(n, F.col(key).eqNullSafe(F.col("_of"))).select(key, F.array_join(F.transform("t", lambda x: x["issue"]), "; ").alias("message"), "issues")


def recent_errors(v: DataFrame, key: str = "pmc_id", last: int = 10) -> DataFrame:
    """The articles with issues whose last such finding (by id) is latest: key, that id and the number of issues. The limit is
    the feature."""
    bad = v.where(F.size("issues") > 0).groupBy(key).agg(F.max("id").alias("last_id"), F.sum(F.size("issues")).alias("issues"))
    return bad.orderBy(F.desc("last_id")).limit(last)


def validation_report(v: DataFrame, validity: DataFrame) -> DataFrame:
    """One row: articles validated, valid, validity rate, and the recommendations that follow."""
    s = validity.agg(F.count(F.lit(1)).alias("validated"), F.count_if("valid").alias("valid"))
    s = s.withColumn("rate", F.coalesce(F.round(100.0 * F.try_divide("valid", "validated"), 6), F.lit(0.0)))
    first = common_issues(v, 1).agg(F.max("issue").alias("top_issue"))
    j = s.crossJoin(F.broadcast(first))  # one row each
    advice = _all(
        (F.col("rate") < 80, "high error rate"),
        (F.contains("top_issue", F.lit("CI")), "review CI extraction"),
        (F.contains("top_issue", F.lit("P-value")), "review P-value extraction"),
        (F.contains("top_issue", F.lit("Sample size")), "review sample sizes"),
        (F.col("validated") - F.col("valid") > 100, "manual review"),
    )
    return j.withColumn("recommendations", F.array_join(advice, "|"))


def compare_sets(f: DataFrame, key: str = "pmc_id") -> DataFrame:
    """Per article, of the typed findings by extractor: intervals (3 decimals) and p-values (6) that both, only one or
    only the other has; totals and the improvement over the pattern baseline in percent."""
    k = F.col("kind")
    value = F.when(k == "confidence_interval", F.struct(F.round("lo", 3).alias("a"), F.round("hi", 3).alias("b"))).when(k == "p_value", F.struct(F.round("num", 6).alias("a"), F.lit(0.0).alias("b")))
    distinct = f.withColumn("v", value).where("v is not null and v.a is not null and v.b is not null").groupBy(key, "kind", "v.a", "v.b").agg(F.max(F.col("extractor") == "llm").alias("l"), F.max(F.col("extractor") == "regex").alias("r"))
    n = lambda kind, c: F.count_if((k == kind) & c)
    l, r = F.col("l"), F.col("r")
    sets = distinct.groupBy(key).agg(*[n(kind, c).alias(f"{s}_{name}") for kind, s in (("confidence_interval", "ci"), ("p_value", "p")) for name, c in (("both", l & r), ("llm_only", l & ~r), ("regex_only", r & ~l))])
    totals = f.groupBy(key).agg(F.count_if(F.col("extractor") == "llm").alias("llm_total"), F.count_if(F.col("extractor") == "regex").alias("regex_total"))
    rate = F.round((F.col("llm_total") - F.col("regex_total")) / F.greatest("regex_total", F.lit(1)) * 100, 6)
    names = [f"{s}_{x}" for s in ("ci", "p") for x in ("both", "llm_only", "regex_only")]
    return totals.join(sets, key, "left").na.fill(0, names).withColumn("improvement_pct", rate)
