"""Mixing sources to target weights.

Every document gets a hash-random key; its source's key range is cut into equal buckets, so that a bucket is a
range of the source's random order and holds about an equal part of it, however large the source is. Token sums
by bucket give the distributed prefix sums; only the one bucket in which a source's budget ends is sorted.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.runtime import strip, written

BUCKETS = 1024
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
_SAMPLED = {}


def source_key(c: Column) -> Column:
    """A source's name in one spelling: no outer blanks, lower case, one hyphen between words."""
    return F.regexp_replace(F.lower(strip(c)), r"(?U)[\s_\-\p{Z}]+", "-")


def _encoder(folder: str):
    if folder not in _SAMPLED:
        import base64
        import importlib.util

        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers_dir", f"{folder}/__init__.py")
        mod = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(mod)
        with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _SAMPLED[folder] = tiktoken.Encoding("byte_bpe_50k", pat_str=mod.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _SAMPLED[folder]


def token_counter(folder: str = TOKENIZER_DIR):
    """A pandas UDF: tokens of each text by the public byte-level tokenizer in folder; null and empty texts have 0."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(folder)
        for texts in parts:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


def sized_documents(docs: DataFrame, targets: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = 17, folder: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, source_name, tokens, key, bucket) of the documents of listed sources, written once: texts are tokenized
    a single time. Documents of null or unlisted sources are left out before their texts are tokenized."""
    listed = targets.select(source_key(F.col("source_name")).alias("source_name")).where("source_name is not null").distinct()
    key = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40))
    d = (
        docs.select(F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("source_name"), F.col(text_col).alias("txt"))
        .join(listed, "source_name", "left_semi")
        .select("doc_id", "source_name", token_counter(folder)("txt").alias("tokens"))
    )
    d = d.withColumn("key", key).withColumn("bucket", F.shiftright("key", 30).cast("int"))
    return written(d, "sized-documents")


def budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: its documents' tokens, its budget, how many whole epochs and how many tokens of another
    epoch it contributes. Targets are few; a name listed twice (in any spelling) counts with its weights together and
    the larger cap. A source with no tokens has nothing to give."""
    t = targets.where("source_name is not null").groupBy(source_key(F.col("source_name")).alias("source_name")).agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
    have = sized.groupBy("source_name").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    total = have.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"))
    b = t.join(have, "source_name", "left").crossJoin(F.broadcast(total)).na.fill(0, ["tokens", "documents"])  # total: one row
    budget = F.col("weight") * F.col("total_tokens")
    b = b.withColumn("budget", F.floor(budget).cast("long")).withColumn("short", F.col("tokens") * F.col("max_repeats") < budget)
    whole = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.col("max_repeats"))).otherwise(F.lit(0)).cast("long")
    return b.withColumn("epochs", whole).withColumn("rest", F.when(F.col("epochs") < F.col("max_repeats"), F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0)))


def mix(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, source_name, tokens, copies) of every document the mix uses. A source's documents are taken in the
    order of their random keys until its budget is reached; a source smaller than its budget is taken whole as often
    as the budget and max_repeats allow, then from the start again."""
    by = sized.groupBy("source_name", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    upto = Window.partitionBy("source_name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most BUCKETS rows a target, whatever the number of documents
    starts = by.withColumn("before", F.coalesce(F.sum("bucket_tokens").over(upto), F.lit(0))).join(plan.select("source_name", "epochs", "rest"), "source_name")
    d = sized.join(starts, ["source_name", "bucket"])
    inside = F.col("before") + F.col("bucket_tokens") <= F.col("rest")
    edge = ~inside & (F.col("before") < F.col("rest"))
    run = Window.partitionBy("source_name", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = d.where(edge).withColumn("upto", F.col("before") + F.sum("tokens").over(run)).withColumn("more", (F.col("upto") <= F.col("rest")).cast("long"))
    cols = ["doc_id", "source_name", "tokens", (F.col("epochs") + F.col("more")).alias("copies")]
    whole = d.where(~edge).withColumn("more", inside.cast("long")).select(*cols)
    return whole.unionByName(cut.select(*cols)).where("copies > 0")


def share_report(mixed: DataFrame, plan: DataFrame) -> DataFrame:
    """Per target: its weight, what the mix really holds of it in tokens and as a share, and whether it stays short."""
    got = mixed.groupBy("source_name").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    r = plan.join(got, "source_name", "left").na.fill(0, ["mixed_tokens", "most_copies"])
    total = r.agg(F.sum("mixed_tokens").alias("_all"))
    return r.crossJoin(F.broadcast(total)).withColumn("share", F.when(F.col("_all") > 0, F.col("mixed_tokens") / F.col("_all"))).drop("_all")
