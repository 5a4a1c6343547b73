"""Model calls and answers: a client per task, answers to rows, findings with defaults."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import dialect
from statloom.functions.patterns import IMPLEMENTED, STRUCTURED
from statloom.operators import nested


class Client(Protocol):
    def complete(self, prompt: str) -> str:
        """The model's answer; raises on failure."""


class RecordedClient:
    """Answers from a table of recorded ones, for runs without a model."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def complete(self, prompt: str) -> str:
        return self.answers[prompt]


class PatternClient:
    """Answers every prompt with the findings that patterns see in it: an offline stand-in for a model."""

    def __init__(self):
        self.patterns = [(t, dialect.python(p)) for p, t in STRUCTURED.values()]

    def complete(self, prompt: str) -> str:
        hits = [{"type": t, "value": m.groups()[-1], "raw_text": m.group()} for t, r in self.patterns for m in r.finditer(prompt)]
        return json.dumps({"findings": hits})


ANSWERED = "batch_id string, answer string, status string, attempts int, error string"


class Failover:
    """Several instances as one client: a call goes to the one of the best health score (1, less a tenth an error, half at
    most); one that fails has an error more, and the call goes on to the next best. Fails if all have."""

    def __init__(self, *clients: Client):
        self.clients, self.errors = clients, [0] * len(clients)

    def complete(self, prompt: str) -> str:
        last: Exception | None = None
        for i in sorted(range(len(self.clients)), key=lambda i: (min(0.1 * self.errors[i], 0.5), i)):
            try:
                return self.clients[i].complete(prompt)
            except Exception as e:  # a client may raise anything
                self.errors[i] += 1
                last = e
        raise RuntimeError("all instances failed") from last


def call_model(prompts: DataFrame, make_client: Callable[[], Client], tries: int = 3, backoff: float = 2.0, wait=time.sleep) -> DataFrame:
    """ANSWERED rows. Each task makes one client (a Failover for several instances); a call is tried up to three times, 1, 2,
    4 ... seconds apart. A batch that fails is marked failed, never processed; null prompts fail at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for pdf in batches:
            out = []
            for bid, prompt in zip(pdf["batch_id"], pdf["prompt"], strict=True):
                answer, error, k = None, None, 0
                for k in range(1, tries + 1):
                    if prompt is None:
                        error = "no prompt"
                        break
                    try:
                        answer, error = client.complete(prompt), None
                        break
                    except Exception as e:  # the client may raise anything
                        error = f"{type(e).__name__}: {e}"
                        if k < tries:
                            wait(backoff ** (k - 1))
                out.append((bid, answer, "completed" if error is None else "failed", k, error))
            yield pd.DataFrame(out, columns=["batch_id", "answer", "status", "attempts", "error"])

    return prompts.select("batch_id", "prompt").mapInPandas(run, ANSWERED)


def parsed_findings(responses: DataFrame, id_col: str = "response_id", payload: str = "payload") -> DataFrame:
    """Findings of answers in the article-level or flat shape, with defaults: type other, location unknown, confidence 0.5."""
    items = nested.flatten(responses, id_col, payload, nested.finding_items)
    v = F.try_parse_json("item_json")
    g = lambda p, t="string": F.try_variant_get(v, p, t)
    return items.select(
        F.col("record_id").alias("response_id"),
        F.col("parent_pos").alias("article_pos"),
        "item_pos",
        F.coalesce(g("$.type"), F.lit("other")).alias("type"),
        F.coalesce(g("$.location"), F.lit("unknown")).alias("location"),
        F.coalesce(g("$.confidence", "double"), F.lit(0.5)).alias("confidence"),
        g("$.context").alias("context"),
        g("$.raw_text").alias("raw_text"),
        "number",
        "lower",
        "upper",
        "level",
        "text",
    )


def answers_to_articles(batches: DataFrame, found: DataFrame) -> DataFrame:
    """Positional zip of a batch's articles (batch_id, pos, pmc_id) with the answers' articles (batch_id, article_pos, ...):
    articles without an answer stay, with nothing found; a flat answer (article_pos -1) goes to all articles of its batch."""
    f = found.withColumn("_flat", F.col("article_pos") == -1)
    on = (batches.batch_id == f.batch_id) & ((f._flat) | (batches.pos == f.article_pos))
    return batches.join(f, on, "left").select(batches.batch_id, batches.pos, batches.pmc_id, *[f[c] for c in found.columns if c not in ("batch_id",)])


def _unreadable(payload: Column) -> Column:
    """Whether no whole JSON object starts at the answer's first opening brace. Answers without a brace never leave the JVM."""

    @F.pandas_udf("boolean")
    def broken(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: nested.parse_first_object(t) is None)

    braced = F.contains(payload, F.lit("{"))
    return F.coalesce(broken(F.when(braced, payload)), F.lit(True))


def raw_interval_hits(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """For answers that hold no whole object (none at all, or one that was cut off): intervals found in their text by the
    pattern catalogue. Null answers give no row."""
    p = F.lit(dialect.java(dialect.alternation(IMPLEMENTED["confidence_intervals"])))
    raw = responses.where(F.col(payload).isNotNull()).withColumn("_unreadable", _unreadable(F.col(payload))).where("_unreadable").drop("_unreadable")
    return raw.withColumn("intervals", F.regexp_extract_all(F.col(payload), p, F.lit(0)))


def valid_model_findings(found: DataFrame, least: float = 0.2) -> DataFrame:
    """Findings of at least `least` confidence whose value is possible: an interval's bounds in order, a p-value from 0 to 1, a
    sample size over 0. A number inside a text counts; a value in which none can be read is let pass, as is every other type."""
    stated = F.coalesce("number", F.expr("try_cast(regexp_extract(text, '([0-9]+[.]?[0-9]*)', 1) AS DOUBLE)"))
    ok = (
        F.when(F.col("type") == "confidence_interval", F.col("lower") < F.col("upper"))
        .when(F.col("type") == "p_value", stated.between(0, 1))
        .when(F.col("type") == "sample_size", F.floor(stated) > 0)
    )
    return found.where((F.col("confidence") >= least) & F.coalesce(ok, F.lit(True)))
