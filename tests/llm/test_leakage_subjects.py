import random

import pytest
from pyspark.sql import functions as F

from statloom.llm import leakage as lk
from statloom.llm import subjects as sb
from tests.helpers import rows

WORDS = [a + b for a in "ba re ti mo lu ska pre vin".split() for b in "rok tel min sol gan der fish ump".split()]


def brute(docs, items, words=13):
    out = set()
    for d, t in docs:
        w = lk.plain_words_of(t or "").split(" ")
        grams = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}
        for i, p in items:
            v = lk.plain_words_of(p or "").split(" ")
            if any(tuple(v[k : k + words]) in grams for k in range(len(v) - words + 1)):
                out.add((d, i))
    return out


def test_found_as_brute_force(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(13, 80)))) for i in range(40)] + [(99, None), (98, "")]
    docs = []
    for d in range(400):
        t = [rng.choice(WORDS) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items[:40])[1].split(" ")
            s = rng.randint(0, len(w) - 1)
            part = w[s : s + rng.randint(8, 40)]
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = "changed"
            style = rng.randint(0, 4)
            if style == 1:
                part = [f"<i>{x}</i>" for x in part]
            elif style == 2:
                part = [x.upper() + rng.choice([",", "\u00a0", "\n", " --"]) for x in part]
            elif style == 3:
                part = [x.replace("fi", "ﬁ").replace("o", "\u043e", 1) for x in part]
            elif style == 4:
                part = [f"**{x}**" for x in part]
            t[rng.randint(0, len(t)) : 0] = part
        docs.append((d, " ".join(t)))
    docs += [(1000, None), (1001, ""), (1002, "x " * 200_000 + items[0][1]), docs[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame(items, "item_id long, passage string")
    got = lk.leaked(df, it)
    assert {tuple(r) for r in got.where("run_words >= 13").select("doc_id", "item_id").collect()} == brute(docs, items)
    assert len(brute(docs, items)) > 100
    few = lk.BLOCK_CHARS
    try:
        lk.BLOCK_CHARS = 2000  # several blocks, the same result
        again = lk.leaked(df, it)
        assert rows(again) == rows(got)
    finally:
        lk.BLOCK_CHARS = few
    assert lk.leaked(df.limit(0), it).count() == 0 and lk.leaked(df, it.limit(0)).count() == 0


def test_altered_stretch_is_found(spark):
    rng = random.Random(2)
    w = [rng.choice(WORDS) for _ in range(60)]
    bad = w[:]
    bad[30] = "altered"
    del bad[45]
    df = spark.createDataFrame([(1, " ".join(["lead"] * 9 + bad)), (2, "nothing here " * 30)], "doc_id long, text string")
    got = lk.leaked(df, spark.createDataFrame([(7, " ".join(w))], "item_id long, passage string"), words=20, edits=1).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 7)]
    assert got[0]["run_words"] == 30 and got[0]["aligned_words"] == 58 and got[0]["edits"] <= 3


TOPICS = {"bio": "enzyme genome protein ribosome plasmid codon".split(), "law": "statute tribunal verdict clause appeal treaty".split(), "sport": "sprint stadium referee goalkeeper marathon relay".split()}
FRAMES = ["Changes in {} were small and {} rose.", "We compared {} with {} over six weeks.", "Earlier work on {} rarely reported {}.", "Missing values of {} were due to {}."]
PASS = ["Nobody had soaked the {} tray so {} looked hollow.", "The baker copied ten samples of {} near {}."]


def sentence(rng, topic, frames=FRAMES):
    return rng.choice(frames).format(rng.choice(TOPICS[topic]), rng.choice(TOPICS[topic]))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    docs, truth = [], {}
    for d in range(600):
        own = rng.sample(sorted(TOPICS), rng.choice([1, 1, 2]))
        other = rng.choice([t for t in TOPICS if t not in own])
        body = [sentence(rng, t) for t in own for _ in range(6)] + [sentence(rng, other)] * (d % 3 == 0) + ["Data are available from the office on request."]
        if d % 5 == 0:
            body += [sentence(rng, other, PASS) for _ in range(8)]
        rng.shuffle(body)
        docs.append((d, f"A title about {rng.choice(TOPICS[other])} and {rng.choice(TOPICS[other])}\n" + " ".join(body)))
        truth[d] = set(own)
    items = [(i, " ".join(sentence(rng, rng.choice(sorted(TOPICS)), PASS) for _ in range(5))) for i in range(60)]
    return docs, truth, items


def test_subjects_on_held_out_documents(spark, corpus):
    docs, truth, items = corpus
    df = spark.createDataFrame(docs + [(9000, None), (9001, ""), (9002, "Data are available from the office on request.")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, c, "a") for d in range(300) for c in truth[d]] + [(1, "unknown_code", "a"), (2, None, "a"), (77777, "bio", "a")], "doc_id long, subject_code string, annotator string")
    codes = spark.createDataFrame([(c, c) for c in TOPICS], "subject_code string, description string")
    model = sb.fit(df, labels, codes, spark.createDataFrame(items, "item_id long, passage string"))
    got = {(r["doc_id"], r["subject_code"]) for r in sb.document_subjects(df, model).collect()}
    want = {(d, c) for d in range(300, 600) for c in truth[d]}
    mine = {x for x in got if 300 <= x[0] < 600}
    assert len(mine & want) >= 0.97 * len(want) and len(mine & want) >= 0.97 * len(mine)
    assert not [x for x in got if x[0] >= 9000]
    comp = {r["subject_code"]: r for r in sb.composition(sb.document_subjects(df, model)).collect()}
    assert sum(r["shared_documents"] for r in comp.values()) == pytest.approx(len({d for d, _ in got}))
    assert sb.document_subjects(df.limit(0), model).count() == 0


def test_no_labels(spark, corpus):
    df = spark.createDataFrame(corpus[0][:20], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, subject_code string, annotator string")
    codes = spark.createDataFrame([(c, c) for c in TOPICS], "subject_code string, description string")
    assert sb.document_subjects(df, sb.fit(df, labels, codes)).count() == 0


def test_long_and_repeated_labelled_documents(spark, corpus):
    """A document beyond the bound is passed over and not the rest with it; any number of rows of an id are one; a bound
    that no document meets is an error."""
    docs, truth, items = corpus
    long = [(d, "x " * 150_000) for d in range(600, 640)]
    df = spark.createDataFrame(docs[:200] + long + docs[:5] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(d, c, "a") for d in range(200) for c in truth[d]] + [(d, "bio", "a") for d in range(600, 640)], "doc_id long, subject_code string, annotator string")
    codes = spark.createDataFrame([(c, c) for c in TOPICS], "subject_code string, description string")
    passages = spark.createDataFrame(items, "item_id long, passage string")
    model = sb.fit(df, labels, codes, passages, max_chars=sum(len(t) for _, t in docs[:200]))
    test = spark.createDataFrame(docs[200:], "doc_id long, text string")
    got = {tuple(r) for r in sb.document_subjects(test, model).select("doc_id", "subject_code").collect()}
    want = {(d, c) for d in range(200, 600) for c in truth[d]}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)
    with pytest.raises(ValueError, match="max_chars"):
        sb.fit(df, labels, codes, passages, max_chars=5)
    few = sb.MAX_PASSAGE_CHARS
    try:
        sb.MAX_PASSAGE_CHARS = 10
        with pytest.raises(ValueError, match="MAX_PASSAGE_CHARS"):
            sb.fit(df, labels, codes, passages)
    finally:
        sb.MAX_PASSAGE_CHARS = few


def test_parts_are_one_whole():
    texts = [f"word{i} alpha beta. gamma{i % 7} delta\n" * (1 + i % 5) for i in range(200)] + ["", "end"]
    whole = sb.split_words(texts)
    most = sb.SPLIT_CHARS
    try:
        sb.SPLIT_CHARS = 500
        parts = sb.split_words(texts)
    finally:
        sb.SPLIT_CHARS = most
    for f in ("hashes", "sentence", "starts", "text", "whole"):
        assert (getattr(whole, f) == getattr(parts, f)).all()


def test_words_hash_alike():
    w = sb.split_words(["alpha beta. alpha\n", "beta gamma alpha!"])
    assert w.hashes[0] == w.hashes[2] == w.hashes[5] and w.hashes[1] == w.hashes[3] and len(set(w.hashes)) == 3
    assert w.text.tolist() == [0, 0, 1] and w.whole.tolist() == [True, False, True]
    assert len(sb.split_words([]).hashes) == 0 and len(sb.split_words(["", "  "]).hashes) == 0
