"""Filling fixed-capacity batches: bounded-space online best-fit.

Each task packs its own rows as they come. A fixed number of bins is open; a bitset keyed by free space finds the
fullest open bin an item still fits in with two integer operations. When one bin too many is open, the fullest is
closed. Nothing is sorted, shuffled or gathered, and a task's memory doesn't depend on the number of rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_TOKENS = 8000
PACKED = "id long, piece int, pieces int, batch long, tokens long"
#: Batches a task can number before it would reach the next task's range.
_PER_TASK = 1 << 40


class BestFit:
    """Bounded-space best-fit over integer sizes of at most capacity."""

    def __init__(self, capacity: int, open_bins: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, open_bins, first
        self.free_bits, self.by_free, self.open = 0, {}, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            del self.by_free[free]
            self.free_bits &= ~(1 << free)
        self.open -= 1
        return b

    def _keep(self, b: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(b)
        self.free_bits |= 1 << free
        self.open += 1

    def place(self, size: int) -> int:
        """The bin for an item: the fullest open one with room, else a new one."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)  # the fullest closes
            free, b = self.capacity, self.next
            self.next += 1
        if free - size:
            self._keep(b, free - size)
        return b


def token_estimate(*cols: str) -> Column:
    """Characters of all columns together, null as empty, over 4, rounded down."""
    return F.floor(sum((F.coalesce(F.length(c), F.lit(0)) for c in cols), F.lit(0)) / 4).cast("long")


def pack(df: DataFrame, id_col: str, size: Column, capacity: int = BATCH_TOKENS, open_bins: int = 32) -> DataFrame:
    """PACKED rows: a batch for every row of df; an item over the capacity becomes full pieces of its own batches and a
    rest that is packed like any item (piece counts from 0, pieces says how many there are).

    Only (id, size) reach Python. Items of size null or 0 take no room but get a batch. Repeated rows are items of
    their own. Batch numbers are unique over all tasks and the same if a task is run again.
    """

    def run(batches):
        bins = BestFit(capacity, open_bins, TaskContext.get().partitionId() * _PER_TASK)
        for pdf in batches:
            out = []
            for rid, n in zip(pdf["id"].to_list(), pdf["size"].to_list(), strict=True):
                full, rest = divmod(n, capacity)
                if full and not rest:
                    full, rest = full - 1, capacity
                for k in range(full):
                    out.append((rid, k, full + 1, bins.next, capacity))
                    bins.next += 1
                out.append((rid, full, full + 1, bins.place(rest), rest))
            yield pd.DataFrame(out, columns=["id", "piece", "pieces", "batch", "tokens"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.greatest(F.coalesce(size, F.lit(0)).cast("long"), F.lit(0)).alias("size")).mapInPandas(run, PACKED)


def fill_report(packed: DataFrame, capacity: int = BATCH_TOKENS) -> DataFrame:
    """Batches, tokens, mean fill and the fewest batches the tokens could take."""
    per = packed.groupBy("batch").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("items"))
    return per.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("items").alias("items"),
        F.sum("tokens").alias("tokens"),
        F.max("tokens").alias("fullest"),
        (F.sum("tokens") / F.count(F.lit(1)) / capacity).alias("mean_fill"),
        F.ceil(F.sum("tokens") / capacity).alias("least_batches"),
    )
