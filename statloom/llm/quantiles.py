"""Percentiles of very large numeric columns: mergeable relative-rank compactors.

A sketch is a stack of compactors; an item of level h stands for 2^h values. A full compactor sorts its items,
protects those of one tail and thins out a number of sections at the other end, which follows a schedule, so that
ranks near the protected tail keep a multiplicative error. Sketches of partitions or days are merged level by
level.

A thinning of level h shifts the rank of a value by 2^h at most, and only of values inside what it thins: not beyond the
thinned value next to the protected tail. Thinnings reach the deeper the rarer they are, so for each level and depth
the sketch keeps their number and how far they have reached. The sum over those that reach a value is a proven bound
of its rank's error, which falls towards the protected tail.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.runtime import written

#: Values a compactor's section has: the proven error near the protected tail is about 1 % of the ranks beyond.
SECTION = 256
#: Values that a task's growing sketches may hold before they are handed on.
HELD = 4_000_000
#: Sections of a new compactor; the number doubles as a compactor is used more.
SECTIONS = 3


class RankSketch:
    """Relative-rank sketch of doubles. high=True protects the high ranks, else the low ones."""

    __slots__ = ("k", "high", "levels", "states", "reach", "n", "low", "top")

    def __init__(self, k: int = SECTION, high: bool = True):
        self.k, self.high, self.n = k, high, 0
        #: (level, depth) -> (thinnings, the value nearest the protected tail that they reached)
        self.reach: dict[tuple[int, int], tuple[int, float]] = {}
        self.levels: list[np.ndarray] = [np.empty(0)]
        self.states: list[int] = [0]
        self.low, self.top = np.inf, -np.inf

    @property
    def error(self) -> int:
        """Bound of the error of any rank; 0 while nothing was thinned out."""
        return sum(n << h for (h, _), (n, _) in self.reach.items())

    def errors(self, values: np.ndarray) -> np.ndarray:
        """Bound of the error of each value's rank (the number of values up to it)."""
        out = np.zeros(len(values), dtype=np.int64)
        for (h, _), (n, far) in self.reach.items():
            out += np.where(values < far if self.high else values >= far, n << h, 0)
        return out

    def _reached(self, h: int, depth: int, n: int, far: float) -> None:
        have, at = self.reach.get((h, depth), (0, far))
        self.reach[h, depth] = (have + n, max(at, far) if self.high else min(at, far))

    def _capacity(self, h: int) -> int:
        uses = self.states[h]
        return 2 * self.k * (SECTIONS << max(0, (uses.bit_length() - SECTIONS + 1) // 2))

    def add(self, values: np.ndarray) -> None:
        """Values without NaN, any number of them."""
        step = self._capacity(0) * 8
        for i in range(0, len(values), step):
            part = values[i : i + step]
            self.n += len(part)
            self.low, self.top = min(self.low, part.min()), max(self.top, part.max())
            self.levels[0] = np.concatenate([self.levels[0], part])
            self._compress()

    def merge(self, other: RankSketch) -> None:
        self.n += other.n
        for (h, depth), (n, far) in other.reach.items():
            self._reached(h, depth, n, far)
        self.low, self.top = min(self.low, other.low), max(self.top, other.top)
        while len(self.levels) < len(other.levels):
            self.levels.append(np.empty(0))
            self.states.append(0)
        for h, items in enumerate(other.levels):
            if len(items):
                self.levels[h] = np.concatenate([self.levels[h], items])
            self.states[h] |= other.states[h]
        self._compress()

    def _compress(self) -> None:
        h = 0
        while h < len(self.levels):
            while len(self.levels[h]) >= (most := self._capacity(h)):
                items = np.sort(self.levels[h])
                state = self.states[h]
                # the schedule: as many sections as the state has trailing ones, and one; all beyond half the capacity go too
                sections = (~state & (state + 1)).bit_length()
                keep = max(most // 2, most - sections * self.k) if len(items) < 2 * most else most // 2
                gone = (len(items) - keep) & ~1
                # high ranks protected: the lowest items are thinned out
                thin, rest = (items[:gone], items[gone:]) if self.high else (items[len(items) - gone :], items[: len(items) - gone])
                if h + 1 == len(self.levels):
                    self.levels.append(np.empty(0))
                    self.states.append(0)
                # a fixed coin: the same values give the same sketch when a task is run again
                coin = (state * 2654435761 >> 7 ^ h ^ gone >> 1) & 1
                self.levels[h + 1] = np.concatenate([self.levels[h + 1], thin[coin::2]])
                self.levels[h] = rest
                self.states[h] = state + 1
                self._reached(h, min(15, gone // self.k), 1, float(thin[-1] if self.high else thin[0]))
            h += 1

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        v = np.concatenate(self.levels)
        w = np.concatenate([np.full(len(x), 1 << h, dtype=np.int64) for h, x in enumerate(self.levels)])
        o = np.argsort(v, kind="stable")
        return v[o], np.cumsum(w[o])

    def at_rank(self, rank: float) -> float:
        """The value whose estimated rank (from 1) first reaches rank."""
        if not self.n:
            return float("nan")
        if rank <= 1:
            return float(self.low)
        if rank >= self.n:
            return float(self.top)
        v, upto = self._sorted()
        return float(v[min(np.searchsorted(upto, rank, side="left"), len(v) - 1)])

    def quantile(self, q: float) -> float:
        """Linear between the two ranks next to q, as for a sorted list; exact while nothing was thinned out."""
        at = q * (self.n - 1) + 1
        lo = self.at_rank(np.floor(at))
        return lo if at == np.floor(at) else lo + (self.at_rank(np.floor(at) + 1) - lo) * (at - np.floor(at))

    def ranks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different values kept, the estimated rank of each and the bound of its error."""
        v, upto = self._sorted()
        last = np.append(v[1:] != v[:-1], True) if len(v) else np.zeros(0, bool)
        v, upto = v[last], upto[last]
        return v, upto, self.errors(v)

    def bounds(self, q: float) -> tuple[float, float]:
        """Values between which the exact quantile surely lies."""
        if not self.n:
            return float("nan"), float("nan")
        at = q * (self.n - 1) + 1
        v, rank, error = self.ranks()
        # a value's true rank is at least rank - error: the first to reach the upper place is no less than the exact one
        enough = np.flatnonzero(rank - error >= np.ceil(at))
        high = float(v[enough[0]]) if len(enough) else float(self.top)
        # all values up to one whose rank is surely below the lower place are less than the exact one
        below = np.flatnonzero(rank + error < np.floor(at))
        low = float(v[below[-1]]) if len(below) else float(self.low)
        if len(below) and not error[below[-1]] and not self.error:
            low = float(v[below[-1] + 1])  # nothing thinned out: the next value is the exact one
        return max(low, float(self.low)), min(high, float(self.top))

    def rank_error(self, q: float) -> int:
        """Bound of the rank error of the answer for q."""
        return int(self.errors(np.array([self.quantile(q)]))[0]) if self.n else 0

    def dumps(self) -> bytes:
        head = struct.pack("<HBqddBH", self.k, self.high, self.n, self.low, self.top, len(self.levels), len(self.reach))
        reach = b"".join(struct.pack("<BBqd", h, depth, n, far) for (h, depth), (n, far) in sorted(self.reach.items()))
        return head + reach + b"".join(struct.pack("<qI", s, len(x)) + np.asarray(x, dtype="<f8").tobytes() for s, x in zip(self.states, self.levels, strict=True))

    @classmethod
    def loads(cls, blob: bytes, at: int = 0) -> tuple[RankSketch, int]:
        k, high, n, low, top, m, r = struct.unpack_from("<HBqddBH", blob, at)
        s = cls(k, bool(high))
        s.n, s.low, s.top, s.levels, s.states = n, low, top, [], []
        at += struct.calcsize("<HBqddBH")
        for _ in range(r):
            h, depth, count, far = struct.unpack_from("<BBqd", blob, at)
            s.reach[h, depth] = (count, far)
            at += struct.calcsize("<BBqd")
        for _ in range(m):
            state, size = struct.unpack_from("<qI", blob, at)
            at += struct.calcsize("<qI")
            s.levels.append(np.frombuffer(blob, "<f8", size, at))
            s.states.append(state)
            at += 8 * size
        return s, at


#: A bundle is one group's sketches of several pieces: runs of (piece, values as they are) or of (piece, sketch).
def _bundle(pieces: dict[int, RankSketch]) -> bytes:
    out = []
    for p in sorted(pieces):
        s = pieces[p]
        if not s.reach:  # nothing thinned out: the values alone
            v = s.levels[0] if len(s.levels) == 1 else np.concatenate(s.levels)
            out.append(struct.pack("<iI", p, len(v)) + np.asarray(v, dtype="<f8").tobytes())
        else:
            out.append(struct.pack("<iI", p, 0) + s.dumps())
    return b"".join(out)


def _runs(piece: np.ndarray, values: np.ndarray) -> bytes:
    """A bundle of plain values, sorted by piece."""
    cuts = np.flatnonzero(np.diff(piece)) + 1
    starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(piece)]
    return b"".join(struct.pack("<iI", int(piece[a]), b - a) + values[a:b].tobytes() for a, b in zip(starts, ends, strict=True))


def unbundle(blob: bytes, k: int, high: bool) -> dict[int, RankSketch]:
    out, at = {}, 0
    while at < len(blob):
        piece, size = struct.unpack_from("<iI", blob, at)
        at += 8
        if size:
            s = RankSketch(k, high)
            s.add(np.frombuffer(blob, "<f8", size, at))
            at += 8 * size
        else:
            s, at = RankSketch.loads(blob, at)
        if piece in out:
            out[piece].merge(s)
        else:
            out[piece] = s
    return out


def piece_sketches(df: DataFrame, groups: Sequence[str], value: str, piece: str | None = None, k: int = SECTION, high: bool = True, flush: int = 400_000) -> DataFrame:
    """(groups..., sketches binary): a bundle of sketches, one per piece, for every group.

    Built in two steps: each task first sketches the rows it has (map-side combine; memory bounded by flush rows and
    the sketches), and only sketches are shuffled, so that a group with a third of all rows is no larger than others
    by more than the logarithm of its size. Null and NaN values are passed over; groups without any value get no row.
    """
    names = list(groups)
    schema = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in names) + ", sketches binary"

    def build(batches):
        held: dict[tuple, dict[int, RankSketch]] = {}
        for pdf in _coalesced(batches, flush):
            v = pdf["_v"].to_numpy(dtype="<f8")
            p = pdf["_p"].to_numpy()
            code = pdf.groupby(names, sort=False, dropna=False).ngroup().to_numpy()
            o = np.lexsort((p, code))
            code, p, v = code[o], p[o], v[o]
            cuts = np.flatnonzero(np.diff(code)) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(code)]])
            keys = pdf[names].iloc[o[starts]].itertuples(index=False, name=None)
            rows = []
            for key, a, b in zip(keys, starts.tolist(), ends.tolist(), strict=True):
                if b - a <= 4 * k and key not in held:
                    rows.append((*key, _runs(p[a:b], v[a:b])))
                else:
                    own = held.setdefault(key, {})
                    cut = [a, *(a + 1 + np.flatnonzero(np.diff(p[a:b]))).tolist(), b]
                    for x, y in zip(cut[:-1], cut[1:], strict=True):
                        own.setdefault(int(p[x]), RankSketch(k, high)).add(v[x:y])
            if sum(len(x) for own in held.values() for sk in own.values() for x in sk.levels) > HELD:
                rows += [(*key, _bundle(sk)) for key, sk in held.items()]
                held.clear()
            yield pd.DataFrame(rows, columns=[*names, "sketches"])
        yield pd.DataFrame([(*key, _bundle(s)) for key, s in held.items()], columns=[*names, "sketches"])

    cols = [*names, F.col(value).cast("double").alias("_v"), (F.col(piece).cast("int") if piece else F.lit(0)).alias("_p")]
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).where(F.col(piece).isNotNull() if piece else F.lit(True)).select(*cols)
    return merged(rows.mapInPandas(build, schema), names, k, high)


def _coalesced(batches, least: int):
    """Arrow batches put together to about least rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= least:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def merged(sketches: DataFrame, groups: Sequence[str], k: int = SECTION, high: bool = True, keep_pieces: bool = True) -> DataFrame:
    """Bundles of the same group merged; keep_pieces=False also merges a group's pieces into one (numbered 0).

    A group's bundles come one after another, and a task holds the sketches of one group, never a group's rows.
    """
    names = list(groups)
    schema = ", ".join(f"`{g}` {sketches.schema[g].dataType.simpleString()}" for g in names) + ", sketches binary"

    def fold(batches):
        key, own, done = None, None, []
        for pdf in batches:
            for *k, blob in pdf[[*names, "sketches"]].itertuples(index=False, name=None):
                if own is None or not _same(k, key):
                    if own is not None:
                        done.append((*key, _bundle(own)))
                    key, own = k, {}
                for p, s in unbundle(blob, k_, high).items():
                    p = p if keep_pieces else 0
                    if p in own:
                        own[p].merge(s)
                    else:
                        own[p] = s
            yield pd.DataFrame(done, columns=[*names, "sketches"])
            done = []
        if own is not None:
            yield pd.DataFrame([(*key, _bundle(own))], columns=[*names, "sketches"])

    k_ = k
    return sketches.repartition(*names).sortWithinPartitions(*names).mapInPandas(fold, schema)


def _same(a: list, b: list) -> bool:
    """Equal keys; pandas gives null as None or NaN."""
    return all(x == y or (x is None or x != x) and (y is None or y != y) for x, y in zip(a, b, strict=True))


def percentiles(sketches: DataFrame, groups: Sequence[str], qs: Sequence[float], k: int = SECTION, high: bool = True) -> DataFrame:
    """(groups..., n, rank_error, and for each q: p<q>, p<q>_rank_error, p<q>_low, p<q>_high): the percentiles over all pieces
    of a group, the proven bounds of the rank error (of any answer, and of each), and the values between which the exact
    ones lie."""
    names = list(groups)
    cols = [f"p{round(q * 1000) / 10:g}".replace(".", "_") for q in qs]
    schema = ", ".join(f"`{g}` {sketches.schema[g].dataType.simpleString()}" for g in names) + ", n long, rank_error long, " + ", ".join(f"{c} double, {c}_rank_error long, {c}_low double, {c}_high double" for c in cols)

    def ask(batches):
        for pdf in batches:
            out = []
            for *key, blob in pdf[[*names, "sketches"]].itertuples(index=False, name=None):
                whole = RankSketch(k, high)
                for s in unbundle(blob, k, high).values():
                    whole.merge(s)
                answers = [x for q in qs for x in (whole.quantile(q), whole.rank_error(q), *whole.bounds(q))]
                out.append((*key, whole.n, whole.error, *answers))
            yield pd.DataFrame(out, columns=[*names, "n", "rank_error", *(x for c in cols for x in (c, f"{c}_rank_error", f"{c}_low", f"{c}_high"))])

    return sketches.select(*names, "sketches").mapInPandas(ask, schema)


def valid_scores(scores: DataFrame) -> DataFrame:
    """Each id once, of its valid rows the first scored: (journal_key, pub_year, run_day, rigor_score). The key, a 64-bit hash
    of the name, and the other three in one number are what is shuffled; named() puts the names back."""
    ok = scores.where("id is not null and journal is not null and pub_year between 1900 and 2025 and rigor_score between 0 and 100")
    low = F.lit(0xFFFFFFFF)
    packed = F.shiftleft((F.col("pub_year") * 128 + F.col("rigor_score")).cast("long"), 32).bitwiseOR(F.coalesce("run_day", F.lit(0)).cast("long").bitwiseAND(low))
    first = F.min(F.struct("scored_at", journal_key().alias("journal_key"), packed.alias("p"))).alias("r")
    r = ok.groupBy("id").agg(first).select("r.journal_key", "r.p")
    both = F.shiftright("p", 32).cast("int")
    return r.select("journal_key", F.floor(both / 128).cast("int").alias("pub_year"), F.shiftright(F.shiftleft("p", 32), 32).cast("int").alias("run_day"), F.pmod(both, F.lit(128)).alias("rigor_score"))


def journal_key() -> Column:
    return F.xxhash64("journal")


def named(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """rows with the journals' names in place of their keys."""
    names = scores.where("journal is not null").groupBy(journal_key().alias("journal_key")).agg(F.min("journal").alias("journal"))
    return rows.join(names, "journal_key").select("journal", *[c for c in rows.columns if c != "journal_key"])


def exact_median(df: DataFrame, groups: Sequence[str], value: Column | str) -> DataFrame:
    """Exact medians from value counts, which partial aggregation keeps small for values of few distinct numbers."""
    counts = df.groupBy(*groups, value).count()
    return counts.groupBy(*groups).agg(F.sum("count").alias("n"), F.percentile(value, F.lit(0.5), F.col("count")).alias("median"))


def shifted_groups(scores: DataFrame, group: str = "pub_year", whole: str = "journal_key", value: str = "rigor_score", piece: str = "run_day", least: int = 30, shift: float = 20, k: int = SECTION) -> DataFrame:
    """(whole, group) whose median lies at least shift from the median of all of whole, with at least `least` values.

    Sketches by piece are merged to groups and those to wholes; the proven bounds of both medians settle which groups
    qualify and which can't. Only those they leave open, and their wholes, are counted exactly.
    """
    # both are asked twice; they are small against the scores
    by_group = written(merged(piece_sketches(scores, [whole, group], value, piece, k), [whole, group], k, keep_pieces=False), "group-sketches")
    g = percentiles(by_group, [whole, group], [0.5], k).where(F.col("n") >= least)
    w = percentiles(merged(by_group.select(whole, "sketches"), [whole], k, keep_pieces=False), [whole], [0.5], k)
    w = w.select(whole, F.col("p50_low").alias("_low"), F.col("p50_high").alias("_high"))
    apart = lambda near, far: F.greatest(F.col(f"p50_{far}") - F.col(f"_{near}"), F.col(f"_{far}") - F.col(f"p50_{near}"))
    near = g.join(w, whole).where(apart("low", "high") >= shift)
    near = written(near.select(whole, group, (apart("high", "low") >= shift).alias("sure")), "near-groups")
    undecided = near.where("not sure").select(whole, group)
    counts = scores.join(undecided.select(whole).distinct(), whole, "left_semi").groupBy(whole, group, value).count()
    med = lambda *by: counts.groupBy(*by).agg(F.percentile(value, F.lit(0.5), F.col("count")).alias("median"))
    total = med(whole).select(whole, F.col("median").alias("_whole"))
    exact = med(whole, group).join(undecided, [whole, group], "left_semi").join(total, whole)
    settled = exact.where(F.abs(F.col("median") - F.col("_whole")) >= shift)
    return near.where("sure").select(whole, group).unionByName(settled.select(whole, group))
