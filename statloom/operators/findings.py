"""Findings as typed rows: polymorphic JSON values normalised to one set of columns, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators import nested
from statloom.runtime import WHITE, once, strip


def type_name(c: Column) -> Column:
    """'P-values', 'p_value' and 'p value' are one type."""
    joined = F.regexp_replace(F.translate(F.lower(strip(c)), WHITE + "-", "_" * (len(WHITE) + 1)), "__+", "_")
    return F.when(joined.endswith("s"), F.left(joined, F.length(joined) - 1)).otherwise(joined)


def stated(kind: str, parsed: str) -> dict[str, Column]:
    """What a parsed JSON value of a kind states: lo, hi and level of an interval (bounded: by named bounds), else num; the type of an effect as it is
    written. An interval may be {lower, upper}, a pair, or either inside {value}; a number may stand alone, as text, or
    inside {value}. What can't be read is null."""
    at = lambda path, kind="double": F.try_variant_get(parsed, path, kind)
    ci = F.col(kind) == "confidence_interval"
    return {
        "lo": F.when(ci, F.coalesce(at("$.lower"), at("$.value.lower"), at("$[0]"), at("$.value[0]"))),
        "hi": F.when(ci, F.coalesce(at("$.upper"), at("$.value.upper"), at("$[1]"), at("$.value[1]"))),
        "bounded": F.coalesce(ci & (at("$.lower", "string").isNotNull() | at("$.upper", "string").isNotNull()), F.lit(False)),
        "level": F.when(ci, F.coalesce(at("$.level"), at("$.value.level"), at("$[2]"))),
        "num": F.when(~ci, F.coalesce(at("$.value"), at("$.value.value"), at("$"))),
        "type_text": F.when(F.col(kind) == "effect_size", F.lower(at("$.type", "string"))),
    }


def parsed(rows: DataFrame, type_col: str = "statistic_type", value_col: str = "value", kind: str = "kind") -> DataFrame:
    """rows with kind and what the value states (see stated), each JSON text parsed once."""
    r = once(rows, **{kind: type_name(F.col(type_col)), "_parsed": F.try_parse_json(value_col)})
    return once(r, **stated(kind, "_parsed")).drop("_parsed")


def typed(rows: DataFrame, type_col: str = "statistic_type", value_col: str = "value") -> DataFrame:
    """Adds kind, lo, hi, level (intervals), num (all others), name (effects); see stated."""
    p = parsed(rows, type_col, value_col)
    return p.withColumn("name", F.regexp_replace("type_text", r"[\s\-]+", "_")).drop("type_text")


def by_extractor(f: DataFrame) -> DataFrame:
    """One row per finding and extractor that has it: 'both' counts for either; other sources are left out."""
    s = F.lower(strip(F.col("source")))
    who = F.when(s == "both", F.array(F.lit("llm"), F.lit("regex"))).when(s.isin("llm", "regex"), F.array(s))
    return f.withColumn("extractor", F.explode(who))


#: Kinds of items by the list or type they come under, and names of effects by how they are written.
KINDS = {"p_values": "p_value", "sample_sizes": "sample_size", "confidence_intervals": "confidence_interval", "effect_sizes": "effect_size", "ci": "confidence_interval"}
EFFECT_NAMES = {"d": "cohens_d", "cohen's d": "cohens_d", "r": "correlation", "or": "odds_ratio", "odds ratio": "odds_ratio", "hr": "hazard_ratio", "hazard ratio": "hazard_ratio", "rr": "risk_ratio"}
RECORD = ("pmc_id", "id", "extractor", "kind", "name", "lo", "hi", "level", "num")


def _renamed(c: Column, names: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in names.items()], c)


def _number(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")


def _place() -> Column:
    return F.struct("record_id", "parent_pos", "item_pos").alias("id")


def of_patterns(lines: DataFrame) -> DataFrame:
    """RECORD rows of extraction lines: the matched texts read as numbers. An interval without a level has none yet; what
    can't be read is null. Lines of no article give nothing."""
    items = nested.flatten(lines, "line_id", "line_text", nested.stats_items, nested.stats_article).where("pmc_id is not null")
    t, kind = F.col("text"), _renamed(F.col("kind"), KINDS)
    bare = F.regexp_replace(t, r"\d+(?:\.\d+)?\s*%", "")
    bound = lambda i: F.nullif(F.regexp_extract(bare, r"(-?\d+(?:\.\d+)?)\s*(?:,|-|–|to)\s*(-?\d+(?:\.\d+)?)", i), F.lit("")).try_cast("double")
    p, n, e = _number(t, r"[=<>≤≥]\s*(\d*\.?\d+(?:[eE][-+]?\d+)?)"), _number(F.regexp_replace(t, ",", ""), r"(\d+)"), _number(t, r"[=:]\s*(-?\d*\.?\d+)")
    ci = kind == "confidence_interval"
    num = F.when(kind == "p_value", p).when(kind == "sample_size", n).when(kind == "effect_size", e)
    name = F.nullif(_renamed(F.lower(F.trim(F.regexp_extract(t, r"^([^=:]*)[=:]", 1))), EFFECT_NAMES), F.lit(""))
    return items.where(kind.isin(*KINDS.values())).select(
        "pmc_id",
        _place(),
        F.lit("regex").alias("extractor"),
        kind.alias("kind"),
        F.when(kind == "effect_size", name).alias("name"),
        F.when(ci, F.coalesce("lower", bound(1))).alias("lo"),
        F.when(ci, F.coalesce("upper", bound(2))).alias("hi"),
        F.when(ci, F.coalesce("level", _number(t, r"(\d+(?:\.\d+)?)\s*%"))).alias("level"),
        F.when(~ci, F.coalesce("number", num)).alias("num"),
    )


def of_model(responses: DataFrame) -> DataFrame:
    """RECORD rows of model answers, as they are typed; texts such as '<0.05' are no numbers. Findings of no article give
    nothing."""
    items = nested.flatten(responses, "response_id", "payload", nested.finding_items, nested.finding_article).where("pmc_id is not null")
    kind = _renamed(type_name(F.try_variant_get(F.try_parse_json("item_json"), "$.type", "string")), KINDS)
    r = once(items, _kind=kind).where(F.col("_kind").isin(*KINDS.values()))
    ci, k = F.col("_kind") == "confidence_interval", F.col("_kind")
    name = F.when((k == "effect_size") & (F.col("variant") == "effect"), F.regexp_replace(F.lower("text"), r"[\s\-]+", "_"))
    return r.select("pmc_id", _place(), F.lit("llm").alias("extractor"), k.alias("kind"), name.alias("name"), *[F.when(ci, F.col(c)).alias(n) for c, n in (("lower", "lo"), ("upper", "hi"), ("level", "level"))], F.when(~ci, F.col("number")).alias("num"))


def of_both(lines: DataFrame, responses: DataFrame) -> DataFrame:
    """The findings of patterns and model, to be merged by article."""
    return of_patterns(lines).unionByName(of_model(responses))
