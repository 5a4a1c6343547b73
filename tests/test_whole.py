"""Texts are handled whole: nothing behind a fixed number of characters is lost."""

from statloom.functions import dialect
from statloom.functions.patterns import STRUCTURED
from statloom.operators import batching
from statloom.plans import registry

ARTICLE = "id long, pmc_id string, title string, abstract string, body string, journal string"


def _pipeline(spark, tmp_path, rows):
    spark.createDataFrame(rows, ARTICLE).write.parquet(f"{tmp_path}/articles.parquet")
    return {r["type"]: r["findings"] for r in registry.queries()["model_pipeline"](spark, str(tmp_path)).collect()}


def test_prompts_hold_whole_texts(spark, tmp_path):
    far = "word " * 1000 + "p = 0.03 and n = 41"
    long = "".join(f"line {k} has p = 0.0{k % 9 + 1} or 5 to {k} here. " for k in range(4000))
    solid = "x" * 70_000 + "n = 12"
    rows = [(1, "PMC1", "t", "a" * 600 + " p = 0.01", far, "J"), (2, "PMC2", None, "b", long, "J"), (3, None, "t", None, solid, "J"), (4, "PMC4", "t", "a", None, "J")]
    df = spark.createDataFrame(rows, ARTICLE)
    got = batching.prompts(df, batching.pack_batches(df), "END").collect()
    assert all(len(r["prompt"]) <= 4 * 8000 + 200 for r in got)
    mine = sorted((r["part"], r["prompt"]) for r in got if "Article PMC2" in r["prompt"])
    assert len(mine) > 4 and [k for k, _ in mine] == list(range(len(mine)))
    text = "".join(p.split("\n", 1)[1].removesuffix("\n\nEND") for _, p in mine)
    assert text == "Title: \nAbstract: b\nBody: " + long
    assert any(far in r["prompt"] for r in got) and any("p = 0.01" in r["prompt"] for r in got)

    want = {}
    for _, pmc, title, abstract, body, _ in rows:
        whole = f"Article {pmc or ''}\nTitle: {title or ''}\nAbstract: {abstract or ''}\nBody: {body or ''}"
        for p, t in STRUCTURED.values():
            want[t] = want.get(t, 0) + len(dialect.python(p).findall(whole))
    assert _pipeline(spark, tmp_path, rows) == {t: n for t, n in want.items() if n}


def test_no_cut_inside_a_statistic():
    text = "aa 12 to 34 bb"
    spans = batching._spans(text, [dialect.python(p) for p, _ in STRUCTURED.values()])
    for most in range(1, 20):
        pieces = list(batching._cuts(text, most, spans))
        assert "".join(pieces) == text and any("12 to 34" in p for p in pieces)
        assert all(len(p) <= max(most, len("12 to 34")) for p in pieces)


def test_prepared_bodies_keep_tables_captions_and_the_rest(spark):
    fill = "some words here. " * 1000
    body = fill + "Table 1: p = 0.02 in column one. " + fill + "".join(f"Figure {k}. " + f"caption {k} " * 90 for k in range(1, 13)) + fill + "n = 77 at the end"
    short = "Table 2. n = 5"
    rows = [(1, "PMC1", "t", "a", body, "J"), (2, "PMC2", "t", "a", short, "J"), (3, None, None, None, None, None)]
    got = batching.llm_prepare(spark.createDataFrame(rows, ARTICLE)).orderBy("id", "piece").collect()
    mine = [r["body"] for r in got if r["id"] == 1]
    assert len(body) > 50_000 and [r["piece"] for r in got] == [*range(len(mine)), 0, 0]
    assert all(len(p) <= 50_000 for p in mine) and [r["body"] for r in got if r["id"] > 1] == [short, ""]
    joined = "".join(mine)
    head, extra = joined.split("\n\n[TABLE SECTION]\n", 1)
    assert body.startswith(head) and len(head) > 9_900 and joined.endswith(body[len(head) :])
    assert "Table 1: p = 0.02" in extra[:700]
    assert extra.count("[FIGURE CAPTION]") == got[0]["figure_count"] and all(f"[FIGURE CAPTION]\nFigure {k}. " + f"caption {k} " * 90 in extra for k in range(1, 13))
