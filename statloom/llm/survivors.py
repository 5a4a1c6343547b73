"""Best representative of each group of rows that state the same finding, field by field.

Rows are grouped by what they state. For every field the rows with a usable value are candidates. A latent
two-sided quality model learns each source's sensitivity (it states a true value) and specificity (it does not
state a false one) by expectation-maximisation, and keeps every value it judges true. As the sources are few, all
that the model needs of any number of rows is how often each pattern of (sources present, sources stating the
value) occurs; the rows are aggregated to these counts once and the iterations run on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators.findings import parsed
from statloom.runtime import blank, once, strip

#: Texts that stand for no value, and the sources from most to least trusted; all others count as missing.
PLACEHOLDERS = ("n/a", "unknown", "-", "null", "none")
SOURCE_ORDER = ("both", "llm", "regex")
FIELDS = ("source", "context", "location", "confidence")
#: Microseconds of the last instant of the year 9999.
LAST = 253_402_300_799_999_999
#: The model's sources: with three or more, sensitivity and specificity are identified without any labelled row.
MODEL_SOURCES = (*SOURCE_ORDER, "missing")


def word(c: Column) -> Column:
    return F.lower(strip(c))


def usable_text(c: Column) -> Column:
    return ~blank(c) & ~F.coalesce(word(c).isin(*PLACEHOLDERS), F.lit(True))


def is_cut(c: Column) -> Column:
    """The text ends in an ellipsis."""
    return strip(c).rlike(r"(\.\.\.|\[\.\.\.\]|…|\[…\])$")


def with_keys(rows: DataFrame) -> DataFrame:
    """Adds type_key and what the value states: lo and hi of an interval, else num; name of an effect. Numbers are
    doubles, equal whatever their notation. Rows that state nothing readable get null in all four."""
    p = parsed(rows, kind="type_key")
    interval, effect = F.col("type_key") == "confidence_interval", F.col("type_key") == "effect_size"
    p = p.withColumns({c: F.col(c) + F.lit(0.0) for c in ("lo", "hi", "num")})  # one zero
    p = p.withColumn("name", F.regexp_replace("type_text", r"(?U)[\s_\-\p{Z}]+", "")).drop("type_text", "level")
    return p.withColumn("states", F.when(interval, F.col("lo").isNotNull() & F.col("hi").isNotNull()).otherwise(F.col("num").isNotNull() & (~effect | F.col("name").isNotNull())))


KEY = ("pmc_id", "type_key", "lo", "hi", "num", "name")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows that state something, with a hash of what it is instead of the six parts.

    Two 64-bit hashes with different seeds: at 10^11 findings the chance of any clash is below 10^-16."""
    k = with_keys(rows).where(F.col("states") & F.col("pmc_id").isNotNull() & F.col("type_key").isNotNull())
    parts = [x for c in KEY for x in (F.col(c).isNull(), F.col(c))]
    return k.withColumns({"g1": F.xxhash64(*parts), "g2": F.xxhash64(F.lit(7), *parts)}).drop(*[c for c in KEY if c != "pmc_id"], "states")


def source_rank(c: Column) -> Column:
    w = word(c)
    return F.coalesce(*[F.when(w == s, F.lit(i)) for i, s in enumerate(SOURCE_ORDER)], F.lit(len(SOURCE_ORDER)))


def best_rows(rows: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """(group_id, field, from_id) of every group of two or more rows: for each field the id of the row its value is
    taken from. Candidates are ordered by source, then later created_at (null last), then larger id; a cut-off
    context comes behind all whole ones. No row for a field that no row of the group can give.

    Only minima are kept per group, so partial aggregation bounds what is shuffled, whatever a group's size.
    """
    k = keyed(rows)
    # one number orders a field's candidates: 3 bits of cut and source, 59 of time from the last to the first, 64 of id
    age = F.coalesce(F.lit(LAST) - F.unix_micros(F.col("created_at").cast("timestamp")), F.lit(2**59 - 1))
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    back = F.lit(Decimal(2**63 - 1)) - wide(F.col("id"), 20)
    ok = {
        "source": usable_text(F.col("source")),
        "context": usable_text(F.col("context")),
        "location": usable_text(F.col("location")),
        "confidence": F.coalesce(F.col("confidence").between(0, 1), F.lit(False)),
    }
    place = wide(F.col("_rank") * F.lit(2**59) + age, 19) * F.lit(Decimal(2**64)) + back
    late = F.lit(Decimal(2**125))
    k = once(k, _rank=source_rank(F.col("source")).cast("long")).withColumn("_place", place)
    order = {"context": F.when(is_cut(F.col("context")), F.col("_place") + late).otherwise(F.col("_place"))}
    best = [F.min(F.when(ok[f], wide(order.get(f, F.col("_place")), 38))).alias(f) for f in fields]
    groups = k.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("group_id"), *best).where("n > 1")
    from_id = lambda f: (F.lit(Decimal(2**63 - 1)) - F.pmod(F.col(f), F.lit(Decimal(2**64)))).cast("long")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), from_id(f).alias("from_id")) for f in fields])
    return groups.select("group_id", F.explode(pairs).alias("p")).select("group_id", "p.field", "p.from_id").where("from_id is not null")


def survivors(rows: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """One record per group: group_id, pmc_id, the number of rows, and each field's value from its best row."""
    k = best_rows(rows, fields)
    picked = k.join(rows.select(F.col("id").alias("from_id"), *[F.col(f).cast("string").alias(f"v_{f}") for f in fields]), "from_id")
    value = F.coalesce(*[F.when(F.col("field") == f, F.col(f"v_{f}")) for f in fields])
    wide = picked.withColumn("value", value).groupBy("group_id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    return wide.withColumn("confidence", F.col("confidence").cast("double")) if "confidence" in fields else wide


def claims(rows: DataFrame, fields: Sequence[str] = ("location", "context")) -> DataFrame:
    """(g1, g2, field, value, stated, present): which sources, as bits, state the value of a group and which have any
    row in it at all. Cut-off and unusable values are no claims."""
    k = keyed(rows).withColumn("bit", F.element_at(F.array(*[F.lit(1 << i) for i in range(len(MODEL_SOURCES))]), source_rank(F.col("source")) + 1))
    ok = lambda f: usable_text(F.col(f)) & (~is_cut(F.col(f)) if f == "context" else F.lit(True))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.when(ok(f), word(F.col(f).cast("string"))).alias("value")) for f in fields]))
    long = k.select("g1", "g2", "bit", "id", each.alias("c")).select("g1", "g2", "bit", "id", "c.*").where("value is not null")
    by_value = long.groupBy("g1", "g2", "field", "value").agg(F.bit_or("bit").alias("stated"), F.min("id").alias("first_id"))
    present = k.groupBy("g1", "g2").agg(F.bit_or("bit").alias("present"), F.min("id").alias("group_id"), F.count(F.lit(1)).alias("rows"))
    return by_value.join(present.where("rows > 1"), ["g1", "g2"])


def fit_quality(patterns: list[tuple[int, int, int]], sources: Sequence[str], rounds: int = 100) -> tuple[float, dict[str, tuple[float, float]]]:
    """EM over pattern counts (present, stated, count): the share of true values and each source's (sensitivity,
    specificity). Beta(2, 1) priors keep sources that are never contradicted away from 0 and 1; sensitivity and
    specificity add up to 1 at least (1: the source says nothing about truth)."""
    prior, q = 0.7, {s: (0.8, 0.7) for s in sources}
    for _ in range(rounds):
        true_total = all_total = 0.0
        sums = {s: [0.0, 0.0, 0.0, 0.0] for s in sources}
        for present, stated, n in patterns:
            p = posterior(present, stated, prior, q, sources)
            true_total += n * p
            all_total += n
            for i, s in enumerate(sources):
                if present >> i & 1:
                    hit = stated >> i & 1
                    sums[s][0] += n * p * hit
                    sums[s][1] += n * p
                    sums[s][2] += n * (1 - p) * (1 - hit)
                    sums[s][3] += n * (1 - p)
        new = {s: ((a + 2) / (b + 3), (c + 2) / (d + 3)) for s, (a, b, c, d) in sums.items()}
        # a statement is never evidence against a value: as only stated values are seen, sources that seldom coincide
        # would else be taken for liars about everything
        new = {s: (sens, max(spec, 1 - sens)) for s, (sens, spec) in new.items()}
        moved = max([abs(x - y) for s in sources for x, y in zip(new[s], q[s], strict=True)], default=0)
        q, prior = new, (true_total + 2) / (all_total + 3)
        if moved < 1e-9:
            break
    return prior, q


def posterior(present: int, stated: int, prior: float, q: dict[str, tuple[float, float]], sources: Sequence[str]) -> float:
    """Probability that a value is true, given which of the present sources state it."""
    t, f = prior, 1 - prior
    for i, s in enumerate(sources):
        if present >> i & 1:
            sens, spec = q[s]
            t *= sens if stated >> i & 1 else 1 - sens
            f *= 1 - spec if stated >> i & 1 else spec
    return t / (t + f)


def judged(rows: DataFrame, fields: Sequence[str] = ("location", "context"), least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(values, quality). values: group_id, field, value, first_id, posterior, kept – every value judged true is kept, so a
    field may keep several. quality: field, source, sensitivity, specificity, true_share.

    The driver gets at most 3^(number of sources) pattern counts a field, whatever the number of rows.
    """
    spark = rows.sparkSession
    c = claims(rows, fields)
    names = MODEL_SOURCES
    counts = c.groupBy("field", "present", "stated").count().collect()
    quality, scored = [], []
    for f in fields:
        own = [(r["present"], r["stated"], r["count"]) for r in counts if r["field"] == f]
        prior, q = fit_quality(own, names)
        quality += [(f, s, float(q[s][0]), float(q[s][1]), float(prior)) for s in names]
        scored += [(f, p, st, float(posterior(p, st, prior, q, names))) for p, st, _ in own]
    table = spark.createDataFrame(scored, "field string, present int, stated int, posterior double")
    values = c.join(F.broadcast(table), ["field", "present", "stated"]).select("group_id", "field", "value", "first_id", "posterior", (F.col("posterior") >= least).alias("kept"))
    return values, spark.createDataFrame(quality, "field string, source string, sensitivity double, specificity double, true_share double")
