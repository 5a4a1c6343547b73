"""Batches of articles for a model: grouping by content, size-limited packing, prompts, tasks."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions.patterns import CONTENT_FLAGS, FIGURE_MARKS, SIZE_CLASSES, STRUCTURED, TABLE_MARKS, TARGET_TOKENS
from statloom.operators.structured import figure_captions, table_section_count, table_windows
from statloom.runtime import written

#: Characters of a prepared piece, and of a long body's beginning.
PIECE_CHARS, HEAD_CHARS = 50_000, 10_000


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def token_estimate() -> Column:
    """Characters of title, abstract and body over four; null counts as empty."""
    return F.floor((F.length(_text("title")) + F.length(_text("abstract")) + F.length(_text("body"))) / 4).cast("long")


def size_class(length: Column) -> Column:
    out = F.lit(SIZE_CLASSES[-1][1])
    for below, name, _ in reversed(SIZE_CLASSES[:-1]):
        out = F.when(length < below, F.lit(name)).otherwise(out)
    return out


def size_limit(length: Column) -> Column:
    out = F.lit(SIZE_CLASSES[-1][2])
    for below, _, most in reversed(SIZE_CLASSES[:-1]):
        out = F.when(length < below, F.lit(most)).otherwise(out)
    return out


def journal_word(journal: str = "journal") -> Column:
    """First word of the journal in lower case; null and blank journals have none."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(journal, F.lit("")), r"(?U)^\s*(\S+)", 1)), F.lit(""))


def group_key() -> Column:
    """Sorted content flags, journal word and size class, joined: articles of one key are batched together."""
    content = F.concat(_text("body"), _text("abstract"))
    flag = lambda ok, name: F.when(ok, F.lit(name))
    has = lambda *xs: F.contains(content, F.lit(xs[0])) | F.contains(content, F.lit(xs[1]))
    parts = [flag(has("Table", "TABLE"), "has_tables"), flag(has("Figure", "FIGURE"), "has_figures")]
    parts += [flag(content.rlike(dialect.java(p)), name) for name, p in CONTENT_FLAGS.items()]
    parts += [F.concat(F.lit("journal_"), journal_word()), F.concat(F.lit("size_"), size_class(F.length(_text("body"))))]
    return F.array_join(F.array_sort(F.array_compact(F.array(*parts))), "_")


PACKED = "id long, group_key string, batch_no long, pos_in_batch int, tokens long"
#: The most articles in a batch, of any size class.
MOST = max(most for _, _, most in SIZE_CLASSES)


def _ranked(a: DataFrame, slot_rows: int) -> DataFrame:
    """a with each row's rank from 0 within its group in order of (len, a hash of the id, id). Ranks come from counts by length
    and hash range, so no task sorts a group, or the rows of one length."""
    mixed = F.pmod(F.pmod("id", F.lit(1 << 31)) * F.lit(2654435761), F.lit(1 << 32))
    a = a.withColumn("part", F.shiftright(mixed, 22).cast("int"))
    per = a.groupBy("group_key", "len", "part").agg(F.count(F.lit(1)).alias("n"))
    of_len = Window.partitionBy("group_key").orderBy("len").rowsBetween(Window.unboundedPreceding, -1)
    in_len = Window.partitionBy("group_key", "len").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lens = per.groupBy("group_key", "len").agg(F.sum("n").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(of_len), F.lit(0))).drop("m")
    starts = per.withColumn("within", F.coalesce(F.sum("n").over(in_len), F.lit(0))).drop("n").join(lens, ["group_key", "len"])
    rn = F.row_number().over(Window.partitionBy("group_key", "len", "part").orderBy("id")) - 1
    r = a.join(starts, ["group_key", "len", "part"])
    return r.select("id", "group_key", "len", "tokens", (F.col("before") + F.col("within") + rn).alias("rank"))


def _batch_ends(tokens: np.ndarray, lens: np.ndarray, target: int) -> np.ndarray:
    """For each row where the next batch begins if one begins at that row; rows are in order."""
    classes = np.array([c[0] for c in SIZE_CLASSES[:-1]])
    limit = np.array([c[2] for c in SIZE_CLASSES])[np.searchsorted(classes, lens, side="right")]
    upto = np.concatenate([[0], np.cumsum(tokens)])
    n = len(tokens)
    # the first row that would lift the batch over the target; a batch has one row at least
    ends = np.maximum(np.searchsorted(upto[1:], upto[:-1] + target, side="right"), np.arange(n) + 1)
    # the first row at which the batch already holds what that row's class allows
    for most in sorted(set(limit.tolist())):
        of_class = np.flatnonzero(limit == most)
        k = np.searchsorted(of_class, np.arange(n) + most)
        ends = np.where(k < len(of_class), np.minimum(ends, np.append(of_class, n)[k]), ends)
    return np.minimum(ends, n)


def _slices(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each combination of keys, of batches that are in their order."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if held and len(pdf):
            pdf = pd.concat([*held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = np.zeros(len(pdf), dtype=bool)
        for k in keys:
            v = pdf[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), len(pdf)]
        for a, z in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pdf.iloc[a:z]
        held = [pdf.iloc[cuts[-2] :]]
    yield from held


def pack_batches(articles: DataFrame, target: int = TARGET_TOKENS, slot_rows: int = 100_000) -> DataFrame:
    """PACKED rows: within each group in order of body length (then of a hash of the id), a batch closes when the next article
    would lift it over target tokens or it holds as many as that article's size class allows.

    Packing is sequential, but where a batch ends depends only on where it begins, and it has at most MOST rows. So a group is
    cut into slots of slot_rows ranks, each with the MOST ranks behind it; a slot is packed for every place among its first MOST
    at which its first batch can begin, and gives for each where the next slot's first batch begins and how many batches there
    are. These small tables, chained from slot to slot, say which of them is true. The result is that of one pass over the
    group, whatever slot_rows is. Only ids and sizes are shuffled, never texts, and texts are read once.
    """
    if slot_rows < MOST:
        raise ValueError(f"slot_rows must be at least {MOST}")
    a = articles.select(F.col("id").cast("long").alias("id"), group_key().alias("group_key"), F.length(_text("body")).alias("len"), token_estimate().alias("tokens"))
    a = written(a, "pack-sizes")
    ranked = written(_ranked(a, slot_rows), "pack-ranks")
    slot = F.floor(F.col("rank") / slot_rows).cast("long")
    ahead = (F.pmod("rank", F.lit(slot_rows)) < MOST) & (slot > 0)
    slots = F.explode(F.when(ahead, F.array(slot, slot - 1)).otherwise(F.array(slot)))
    rows = ranked.select("id", "group_key", "len", "tokens", "rank", slots.alias("slot"))

    def ends(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
        own = int((pdf["rank"] < (pdf["slot"].iloc[0] + 1) * slot_rows).sum())
        return pdf, _batch_ends(pdf["tokens"].to_numpy(), pdf["len"].to_numpy(), target), own

    def ways(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, nxt, own = ends(pdf)
        at, count = list(range(own + MOST + 1)), [0] * (own + MOST + 1)
        for i in range(own - 1, -1, -1):
            at[i], count[i] = at[nxt[i]], count[nxt[i]] + 1
        first = min(MOST, own) + 1
        head = pdf.iloc[0]
        return pd.DataFrame({"group_key": head["group_key"], "slot": head["slot"], "out": [[x - own for x in at[:first]]], "batches": [count[:first]]})

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, at, number = None, 0, 0
        for pdf in batches:
            out = []
            for g, k, to, count in pdf[["group_key", "slot", "out", "batches"]].itertuples(index=False, name=None):
                if g != group:
                    group, at, number = g, 0, 0
                out.append((g, k, at, number))
                # a slot that ends before its first batch begins is the group's last
                at, number = (int(to[at]), number + int(count[at])) if at < len(to) else (0, number)
            yield pd.DataFrame(out, columns=["group_key", "slot", "enter", "first_no"])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, nxt, own = ends(pdf)
        i, number = int(pdf["enter"].iloc[0]), int(pdf["first_no"].iloc[0])
        nos, poss = np.full(len(pdf), -1), np.zeros(len(pdf), dtype=np.int32)
        while i < own:
            e = int(nxt[i])
            nos[i:e], poss[i:e] = number, np.arange(e - i)
            i, number = e, number + 1
        # rows of the next slot are here only where a batch of this one reaches into it
        return pdf.assign(batch_no=nos, pos_in_batch=poss)[nos >= 0][["id", "group_key", "batch_no", "pos_in_batch", "tokens"]]

    def each(one: Callable[[pd.DataFrame], pd.DataFrame], columns: list[str]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            done, n = [], 0
            for part in _slices(batches, ["group_key", "slot"]):
                done.append(one(part))
                n += len(done[-1])
                if n > 20_000:
                    yield pd.concat(done, ignore_index=True)
                    done, n = [], 0
            yield pd.concat(done, ignore_index=True) if done else pd.DataFrame(columns=columns)

        return run

    by_slot = lambda df: df.repartition("group_key", "slot").sortWithinPartitions("group_key", "slot", "rank")
    # a group of one slot begins where it begins
    cut = ranked.where(slot > 0).select("group_key").distinct()
    tables = by_slot(rows.join(cut, "group_key", "left_semi")).mapInPandas(each(ways, ["group_key", "slot", "out", "batches"]), "group_key string, slot long, out array<long>, batches array<long>")
    entries = tables.repartition("group_key").sortWithinPartitions("group_key", "slot").mapInPandas(chain, "group_key string, slot long, enter int, first_no long")
    known = rows.join(entries, ["group_key", "slot"], "left").na.fill(0, ["enter", "first_no"])
    return by_slot(known).mapInPandas(each(pack, ["id", "group_key", "batch_no", "pos_in_batch", "tokens"]), PACKED)


def adapt_limits(limits: DataFrame, seconds: Column) -> DataFrame:
    """Largest batch sizes after a run: a fifth fewer where a batch took over 60 s, a fifth more (at most 100) under 20 s."""
    m = F.col("most")
    slower, faster = F.greatest(F.lit(1), F.floor(m * 0.8)), F.least(F.lit(100), F.floor(m * 1.2))
    return limits.withColumn("most", F.when(seconds > 60, slower).when(seconds < 20, faster).otherwise(m).cast("int"))


def task_chunks(articles: DataFrame, size: int = 50) -> DataFrame:
    """(id, task): tasks of `size` consecutive ids. Ranks are made by range: rows before a range come from counts by
    range of 2^16 ids, so that no task sees all rows."""
    ids = articles.select(F.col("id").cast("long").alias("id")).withColumn("range", F.shiftright("id", 16))
    before = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ids.groupBy("range").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    rn = F.row_number().over(Window.partitionBy("range").orderBy("id"))
    return ids.join(starts, "range").select("id", F.floor((F.col("before") + rn - 1) / size).cast("long").alias("task"))


def round_robin(ranked: DataFrame, rank: str, k: int) -> DataFrame:
    return ranked.withColumn("instance", F.pmod(F.col(rank), F.lit(k)))


def _cuts(text: str, most: int, spans: list[tuple[int, int]]) -> Iterator[str]:
    """The text in pieces of at most `most` characters, which joined give the text. A piece ends behind white space where it
    can, and never inside a span: a span longer than a piece makes its piece as long."""
    starts = [s for s, _ in spans]

    def inside(at: int) -> tuple[int, int] | None:
        k = bisect_left(starts, at) - 1
        return spans[k] if k >= 0 and spans[k][1] > at else None

    begin = 0
    while len(text) - begin > most:
        end = begin + most
        at = end
        while at > begin and (not text[at - 1].isspace() or inside(at)):
            at -= 1
        if at == begin:
            at = end
            if span := inside(end):
                at = span[0] if span[0] > begin else span[1]
        yield text[begin:at]
        begin = at
    if begin < len(text):
        yield text[begin:]


def _spans(text: str, patterns: Sequence[re.Pattern]) -> list[tuple[int, int]]:
    """Where statistics stand, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(m.span() for r in patterns for m in r.finditer(text)):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def text_pieces(text: Column, most: int) -> Column:
    """The whole text as an array of pieces of at most `most` characters, cut where no statistic is cut in two; null stays."""
    patterns = [p for p, _ in STRUCTURED.values()]

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rx = [dialect.python(p) for p in patterns]
        for texts in batches:
            yield texts.map(lambda t: None if t is None else list(_cuts(t, most, _spans(t, rx))))

    return F.pandas_udf(cut, "array<string>")(text)


def prompt_text() -> Column:
    """One article's title, abstract and body as prompts hold them: whole."""
    return F.concat(F.lit("Title: "), _text("title"), F.lit("\nAbstract: "), _text("abstract"), F.lit("\nBody: "), _text("body"))


def prompts(articles: DataFrame, packed: DataFrame, template: str, target: int = TARGET_TOKENS) -> DataFrame:
    """Prompts of the batches: their articles' blocks in order, then the template. A batch holds at most 50 articles.

    Texts are sent whole: an article of more than target tokens goes on in further prompts of its batch (part 1, 2, ...),
    each piece behind the article's id. No text is sent twice, so findings may be counted over all prompts.
    """
    j = packed.join(articles.select("id", "pmc_id", prompt_text().alias("text")), "id")
    long = F.col("tokens") > target
    j = j.withColumn("cut", text_pieces(F.when(long, F.col("text")), 4 * target))
    j = j.select("group_key", "batch_no", "pos_in_batch", "pmc_id", F.posexplode(F.when(long, F.col("cut")).otherwise(F.array("text"))).alias("part", "piece"))
    begin = F.when(F.col("part") > 0, F.lit(" (continued)\n")).otherwise(F.lit("\n"))
    block = F.concat(F.lit("Article "), F.coalesce("pmc_id", F.lit("")), begin, "piece")
    g = j.groupBy("group_key", "batch_no", "part").agg(F.array_sort(F.collect_list(F.struct("pos_in_batch", block.alias("block")))).alias("b"))
    return g.select("group_key", "batch_no", "part", F.size("b").alias("articles"), F.concat(F.array_join(F.transform("b", lambda x: x["block"]), "\n\n"), F.lit("\n\n" + template)).alias("prompt"))


def _prepared(body: Column) -> Column:
    """Pieces of a long body: its beginning with all table sections and figure captions behind it, then the rest."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rx = [dialect.python(p) for p, _ in STRUCTURED.values()]
        tables, figures = ([dialect.python(p, dotall=True) for p in marks] for marks in (TABLE_MARKS, FIGURE_MARKS))

        def pieces(text: str | None) -> list[str] | None:
            if text is None:
                return None
            head = next(_cuts(text, HEAD_CHARS, _spans(text, rx)))
            parts = [head, *[f"\n\n[TABLE SECTION]\n{text[s:e]}\n" for s, e in table_windows(text, tables)]]
            parts += [f"\n\n[FIGURE CAPTION]\n{m.group()}\n" for r in figures for m in r.finditer(text)]
            return [p for t in ("".join(parts), text[len(head) :]) for p in _cuts(t, PIECE_CHARS, _spans(t, rx))]

        for texts in batches:
            yield texts.map(pieces)

    return F.pandas_udf(run, "array<string>")(body)


def llm_prepare(articles: DataFrame) -> DataFrame:
    """What a model gets of an article, with flags and counts of tables and figures: the body, where it is not over 50,000
    characters. A longer one comes in pieces of at most as many: first about 10,000 characters with all table sections and
    whole figure captions behind them (which repeat text of the body), then the rest of the body; no piece ends inside a
    statistic."""
    body = _text("body")
    long = F.length(body) > PIECE_CHARS
    counted = articles.select("id", "pmc_id", "title", "abstract", body.alias("body"), table_section_count(body).alias("table_count"), F.size(figure_captions(body)).alias("figure_count"), _prepared(F.when(long, body)).alias("cut"))
    pieces = F.when(F.length("body") > PIECE_CHARS, F.col("cut")).otherwise(F.array("body"))
    out = counted.select("id", "pmc_id", "title", "abstract", F.posexplode(pieces).alias("piece", "body"), "table_count", "figure_count")
    return out.withColumns({"has_tables": F.col("table_count") > 0, "has_figures": F.col("figure_count") > 0})
