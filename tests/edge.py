"""Edge versions of the test tables: empty, of nulls, and with further columns whose names operators use inside."""

import glob
import os

from pyspark.sql import functions as F

NAMES = "key id text txt value kind name lo hi num level bit c f m n p q r s t g1 g2 group_id field from_id states type_key extractor source tokens copies bucket epochs rest budget odd plain canonical segments sketches piece pieces batch size journal content_hash changed retry line_text rid subject_code codes weights share element seq marked elements hits rigor_score category item_pos record_id parent_pos".split()


HOT = {
    "articles": ("pmc_id", "journal", "full_text"),
    "extraction_scores": ("journal", "pub_year"),
    "merged_statistics": ("pmc_id", "statistic_type", "value", "context"),
    "llm_processing_status": ("pmc_id",),
    "llm_article_status": ("pmc_id",),
    "documents": ("source", "text"),
    "extraction_jsonl": ("line_text",),
    "llm_responses": ("payload",),
    "events": ("user_id",),
}


def make(spark, data: str, out: str, kind: str) -> str:
    for p in glob.glob(f"{data}/*.parquet"):
        df = spark.read.parquet(p)
        if kind == "empty":
            df = df.limit(0)
        elif kind == "nulls":
            row = df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
            df = row.unionByName(row)
        elif kind == "clash":
            have = {c.lower() for c in df.columns}
            df = df.select("*", *[F.lit("clash").alias(c) for c in NAMES if c not in have])
        elif kind == "hot":
            # a third of all rows share the values of one row in these columns
            name = os.path.basename(p)[: -len(".parquet")]
            hot = [c for c in HOT.get(name, ()) if c in df.columns]
            if hot:
                one = df.where(" and ".join(f"{c} is not null" for c in hot)).orderBy(*df.columns[:1]).first()
                pick = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
                df = df.withColumns({c: F.when(pick, F.lit(one[c]).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in hot})
        elif kind == "some_nulls":
            # every column null in about a tenth of its rows, another tenth for each
            df = df.select(*[F.when(F.pmod(F.xxhash64(*df.columns, F.lit(i)), F.lit(10)) != 0, F.col(c)).alias(c) for i, c in enumerate(df.columns)])
        df.coalesce(1).write.parquet(os.path.join(out, os.path.basename(p)))
    return out
