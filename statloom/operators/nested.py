"""Deeply nested records of varying shape into flat tables that keep parent and place.

A bottom-up tree automaton gives every JSON value a state from its kind and its children's states; the rules are
the tables below. The state of a node says which variant it is, and each variant has its own typed table. All
tables share the supertype's keys (record_id, parent_pos, item_pos), so that they can be joined or united.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("p_values", "sample_sizes", "confidence_intervals", "effect_sizes", "statistical_tests", "power_analysis", "corrections")

#: What the operators return: the supertype's keys, the variant the item was routed to, its typed fields and its own JSON.
ITEM_SCHEMA = "record_id long, parent_pos int, kind string, item_pos int, variant string, number double, lower double, upper double, level double, text string, item_json string"
_FIELDS = [f.split(" ")[0] for f in ITEM_SCHEMA.split(", ")]

_scan = json.JSONDecoder(parse_constant=lambda s: _fail(s))


def _fail(s: str) -> None:
    raise ValueError(f"not JSON: {s}")


def parse_whole(text: str | None):
    """The value of a text that is one JSON value and nothing else; else None."""
    if text is None:
        return None
    try:
        return _scan.decode(text)
    except (ValueError, RecursionError):
        return None


def parse_first_object(text: str | None):
    """The object that starts at the first opening brace, if it is whole; else None."""
    at = -1 if text is None else text.find("{")
    if at < 0:
        return None
    try:
        return _scan.raw_decode(text, at)[0]
    except (ValueError, RecursionError):
        return None


def number(v) -> float | None:
    """A number or a text that is one; else None."""
    if isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        try:
            return float(v)
        except OverflowError:
            return None
    if isinstance(v, str):
        s = v.strip()
        if s[:1] in "+-.0123456789" and s:
            try:
                return float(s)
            except ValueError:
                return None
    return None


class TreeAutomaton:
    """Deterministic, bottom-up: state(value) from its JSON kind and the states of its children.

    object_rules: (state, needed) tried in order; needed maps a key to the states its value may have (None: any).
    array_rules: (state, smallest size, largest size, states that every entry must have). Nothing fits: 'object' or 'array'.
    """

    def __init__(self, object_rules, array_rules):
        self.object_rules, self.array_rules = object_rules, array_rules

    def state(self, v) -> str:
        if v is None:
            return "null"
        if isinstance(v, dict):
            seen: dict[str, str] = {}
            for name, needed in self.object_rules:
                for k, allowed in needed.items():
                    if k not in v:
                        break
                    if allowed is not None:
                        s = seen.get(k)
                        if s is None:
                            s = seen[k] = self.state(v[k])
                        if s not in allowed:
                            break
                else:
                    return name
            return "object"
        if isinstance(v, list):
            states = {self.state(x) for x in v}
            for name, least, most, allowed in self.array_rules:
                if least <= len(v) <= most and states <= allowed:
                    return name
            return "array"
        if isinstance(v, bool):
            return "flag"
        return "number" if number(v) is not None else "text"


_NUM = frozenset({"number"})
#: The shapes in which intervals, findings and matches are written.
INTERVALS = TreeAutomaton(
    [("interval", {"lower": None, "upper": None}), ("interval_in", {"value": frozenset({"interval", "interval_in", "pair"})}), ("group", {"intervals": None}), ("group", {"table": None})],
    [("pair", 2, 3, _NUM)],
)
INTERVAL_STATES = frozenset({"interval", "interval_in", "pair"})
VALUES = TreeAutomaton(
    [
        ("interval", {"lower": None, "upper": None}),
        ("match", {"match": None}),
        ("effect", {"type": None, "value": frozenset({"number"})}),
        ("interval_in", {"value": frozenset({"interval", "interval_in", "pair"})}),
        ("number_in", {"value": frozenset({"number", "number_in"})}),
    ],
    [("pair", 2, 3, _NUM)],
)


def _typed(v, state: str) -> tuple:
    """number, lower, upper, level, text of a value, by its variant."""
    while state in ("interval_in", "number_in"):
        v = v["value"]
        state = VALUES.state(v)
    if state == "interval":
        return None, number(v["lower"]), number(v["upper"]), number(v.get("level")), None
    if state == "pair":
        n = [number(x) for x in v]
        return None, n[0], n[1], n[2] if len(n) > 2 else None, None
    if state == "effect":
        return number(v["value"]), None, None, None, str(v["type"])
    if state == "number":
        return number(v), None, None, None, v if isinstance(v, str) else None
    if state == "match":
        return None, None, None, None, v["match"] if isinstance(v["match"], str) else None
    return None, None, None, None, v if isinstance(v, str) else None


def _entries(v) -> list:
    """The entries of a list; a lone value is entry 0; null has none."""
    return [] if v is None else v if isinstance(v, list) else [v]


def find_stats(record: dict):
    """The stats of a record, wherever they sit: breadth first, so that the outermost wins."""
    level = [record]
    while level:
        below = []
        for v in level:
            if isinstance(v, dict):
                if v.get("stats") is not None:
                    s = v["stats"]
                    s = parse_whole(s) if isinstance(s, str) else s
                    if isinstance(s, dict):
                        return s
                below += v.values()
            elif isinstance(v, list):
                below += v
        level = below
    return None


def stats_items(text: str | None) -> Iterator[tuple]:
    """(parent_pos, kind, item_pos, value) of an extraction line; nothing for a line that is not one whole record."""
    record = parse_whole(text)
    stats = find_stats(record) if isinstance(record, dict) else None
    if stats is None:
        return
    sections = _entries(stats.get("sections"))
    for parent, holder in [(-1, stats), *enumerate(sections)]:
        if isinstance(holder, dict):
            for kind in CATEGORIES:
                for i, v in enumerate(_entries(holder.get(kind))):
                    if v is not None:
                        yield parent, kind, i, v


def finding_items(text: str | None) -> Iterator[tuple]:
    """(parent_pos, 'finding', item_pos, finding) of a model answer, in the article-level or the flat shape."""
    top = parse_first_object(text)
    if top is None:
        return
    for parent, holder in [(-1, top), *enumerate(_entries(top.get("articles")))]:
        if isinstance(holder, dict):
            for i, v in enumerate(_entries(holder.get("findings"))):
                if v is not None:
                    yield parent, "finding", i, v


def interval_items(text: str | None) -> Iterator[tuple]:
    """(parent_pos, 'confidence_intervals', item_pos, interval): in groups, in a plain list, or a lone one."""
    top = parse_whole(text)
    if top is None:
        return
    lone = INTERVALS.state(top) in INTERVAL_STATES
    for i, v in enumerate([top] if lone or not isinstance(top, list) else top):
        state = INTERVALS.state(v)
        if state in INTERVAL_STATES:
            yield -1, "confidence_intervals", i, v
        elif state == "group":
            held = v.get("intervals")
            for k, x in enumerate([held] if INTERVALS.state(held) in INTERVAL_STATES else _entries(held)):
                if INTERVALS.state(x) in INTERVAL_STATES:
                    yield i, "confidence_intervals", k, x


def stats_article(text: str | None) -> Callable[[int], str | None]:
    """Parent position -> pmc_id of an extraction line: what the metadata beside the stats say, or else the record."""
    record = parse_whole(text)
    level, found = [record] if isinstance(record, dict) else [], None
    while level and found is None:
        for v in level:
            meta = v.get("metadata")
            found = next((x for x in (meta.get("pmc_id") if isinstance(meta, dict) else None, v.get("pmc_id")) if isinstance(x, str)), found)
        level = [x for v in level for x in v.values() if isinstance(x, dict)]
    return lambda parent: found


def finding_article(text: str | None) -> Callable[[int], str | None]:
    """Parent position -> pmc_id of a model answer: the article's own, for flat findings the answer's."""
    top = parse_first_object(text)
    articles = _entries(top.get("articles")) if top is not None else []

    def of(parent: int) -> str | None:
        holder = top if parent < 0 else articles[parent]
        pmc = holder.get("pmc_id")
        return pmc if isinstance(pmc, str) else None

    return of


STATS = "line_id long, error string, rigor_score int, p_values int"


def stats_rows(df: DataFrame, id_col: str = "line_id", json_col: str = "line_text") -> DataFrame:
    """STATS rows: of every line that is one whole record its error, and of one with stats, wherever they sit, the score (null
    if it is no whole number) and the number of p-values in the stats and their sections (null: no stats)."""

    def run(batches):
        for pdf in batches:
            out = []
            for rid, text in zip(pdf["rid"], pdf["txt"], strict=True):
                record = parse_whole(text)
                if isinstance(record, dict):
                    stats = find_stats(record)
                    score = stats.get("rigor_score") if stats is not None else None
                    error = record.get("error")
                    out.append((rid, None if error is None else str(error), score if isinstance(score, int) and not isinstance(score, bool) and abs(score) < 2**31 else None, None if stats is None else sum(kind == "p_values" for _, kind, _, _ in stats_items(text))))
            frame = pd.DataFrame(out, columns=["line_id", "error", "rigor_score", "p_values"])
            yield frame.astype({"rigor_score": "Int32", "p_values": "Int32"})

    return df.select(F.col(id_col).cast("long").alias("rid"), F.col(json_col).alias("txt")).where("txt is not null and rid is not null").mapInPandas(run, STATS)


def flatten(df: DataFrame, id_col: str, json_col: str, items: Callable[[str | None], Iterator[tuple]], article: Callable[[str | None], Callable[[int], str | None]] | None = None) -> DataFrame:
    """ITEM_SCHEMA rows of every record of df; with article (see stats_article) also the pmc_id each item is of. Narrow: each record is parsed where it lies, nothing is shuffled.

    A null, broken or foreign text gives no row; repeated records give their rows again; columns other than the two
    named are not read. A finding is typed by its value, other items by themselves.
    """

    schema = ITEM_SCHEMA + ("" if article is None else ", pmc_id string")
    names = _FIELDS + ([] if article is None else ["pmc_id"])

    def run(batches):
        for pdf in batches:
            out = []
            for rid, text in zip(pdf["rid"], pdf["txt"], strict=True):
                of = None
                for parent, kind, pos, v in items(text):
                    value = v.get("value") if kind == "finding" and isinstance(v, dict) else v
                    state = VALUES.state(value)
                    out.append((rid, parent, kind, pos, state, *_typed(value, state), json.dumps(v, ensure_ascii=False)))
                    if article is not None:
                        of = of or article(text)
                        out[-1] = (*out[-1], of(parent))
            yield pd.DataFrame(out, columns=names)

    return df.select(F.col(id_col).cast("long").alias("rid"), F.col(json_col).alias("txt")).where("txt is not null and rid is not null").mapInPandas(run, schema)


def variant_table(items: DataFrame, name: str) -> DataFrame:
    """One subtype's table: the supertype's keys (with the record's table, where items have it) and only the fields that the
    subtype has."""
    keys = [c for c in ("table_name", "record_id", "parent_pos", "kind", "item_pos") if c in items.columns]
    fields = {"intervals": ["lower", "upper", "level"], "numbers": ["number", "text"], "matches": ["text"], "others": ["item_json"]}[name]
    states = {"intervals": ["interval", "interval_in", "pair"], "numbers": ["number", "number_in", "effect"], "matches": ["match", "text"]}
    known = [s for x in states.values() for s in x]
    return items.where(F.col("variant").isin(states[name]) if name in states else ~F.col("variant").isin(known)).select(*keys, *fields)


SOURCES = {"extraction_jsonl": ("line_id", "line_text", stats_items), "llm_responses": ("response_id", "payload", finding_items), "llm_extracted_stats": ("id", "confidence_intervals", interval_items)}


def all_items(tables: dict[str, DataFrame]) -> DataFrame:
    """The items of the three nested sources with the table each comes from."""
    out = None
    for name, (rid, col, items) in SOURCES.items():
        one = flatten(tables[name], rid, col, items).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out
