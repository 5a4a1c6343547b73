"""No leak is lost by the length of an edit or of a passage."""

import random
import tracemalloc

import pytest

from statloom.llm import leakage as lk
from tests.llm.test_leakage_subjects import WORDS


@pytest.mark.parametrize("size", [10, 26, 40, 400])
def test_edits_of_any_length(size):
    rng = random.Random(size)
    for _ in range(60):
        w = [rng.choice(WORDS) for _ in range(20)]
        at = rng.randint(1, 18)
        long = "q" * size
        index = lk.ItemIndex([(7, " ".join(w))], 20, 1)
        lead = ["lead"] * rng.randint(0, 40)
        (got,) = index.leaks([" ".join([*lead, *w[:at], long, *w[at:], "end"])])
        assert got[3] - got[4] >= 19
        (got,) = index.leaks([" ".join([*lead, *w[:at], long, *w[at + 1 :], "end"])])
        assert got[3] - got[4] >= 18
        gone = lk.ItemIndex([(7, " ".join([*w[:at], long, *w[at:]]))], 20, 1)
        (got,) = gone.leaks([" ".join([*lead, *w, "end"])])
        assert got[3] - got[4] >= 19


def test_long_passages_are_aligned_whole():
    rng = random.Random(3)
    w = [rng.choice(WORDS) for _ in range(1500)]
    for words, edits in ((13, 0), (20, 1)):
        assert lk.ItemIndex([(7, " ".join(w))], words, edits).leaks([" ".join(w)]) == [(0, 0, 1500, 1500, 0)]


def test_altered_leaks_are_recalled():
    """1,500 stretches of 20 words with a word put in, taken out or replaced, some by very long ones."""
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(60))) for i in range(50)]
    index = lk.ItemIndex(items, 20, 1)
    found = {"insert": 0, "delete": 0, "replace": 0}
    docs, want = [], []
    for k in range(1500):
        how = ("insert", "delete", "replace")[k % 3]
        item = rng.randrange(50)
        s = rng.randrange(40)
        part = items[item][1].split(" ")[s : s + 20]
        at = rng.randint(1, 18)
        new = [rng.choice([rng.choice(WORDS), "w" * rng.randint(1, 60)])]
        part[at : at + (how != "insert")] = [] if how == "delete" else new
        docs.append(" ".join([*(rng.choice(WORDS) for _ in range(30)), *part, *(rng.choice(WORDS) for _ in range(30))]))
        want.append((k, item, how))
    got = {(d, index.ids[i]) for d, i, _, aligned, edits in index.leaks(docs) if aligned - edits >= 18}
    for d, i, how in want:
        found[how] += (d, i) in got
    assert sum(found.values()) >= 0.99 * 1500 and min(found.values()) >= 0.98 * 500, found


def test_a_stretch_many_items_share():
    """Every pair comes, in memory that doesn't grow with their number."""
    rng = random.Random(1)
    words = lambda n: [rng.choice(WORDS) for _ in range(n)]
    head = words(30)
    items = [(i, " ".join([*head, *words(20)])) for i in range(500)] + [(1000 + i, " ".join(head)) for i in range(50)]
    docs = [" ".join([*words(50), *head, *words(50)]) for _ in range(100)] + [" ".join(words(100))] * 10
    index = lk.ItemIndex(items)
    parts = list(index.search(docs))
    got = {(d, index.ids[i]) for part in parts for d, i, run, *_ in zip(*part, strict=True) if run >= 13}
    assert got == {(d, i) for d in range(100) for i, _ in items}
    assert len(parts) > 1


@pytest.mark.parametrize("limits", [(3000, 60, 500), (200, 5, 20)])
@pytest.mark.parametrize("words, edits", [(13, 0), (20, 1)])
def test_parts_give_the_same(limits, words, edits, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    items += [(100 + i, items[i][1]) for i in range(5)]
    docs = [" ".join([*(rng.choice(WORDS) for _ in range(30)), *items[k % 40][1].split(" ")[5:45], *items[(7 * k) % 40][1].split(" ")]) for k in range(120)]
    whole = sorted(lk.ItemIndex(items, words, edits).leaks(docs))
    for name, value in zip(("TEXT_CHARS", "HITS", "CELLS"), limits, strict=True):
        monkeypatch.setattr(lk, name, value)
    assert sorted(lk.ItemIndex(items, words, edits).leaks(docs)) == whole and len(whole) > 100


def test_memory_of_long_documents():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(60))) for i in range(100)]
    docs = [" ".join(rng.choice(WORDS) for _ in range(20_000)) for _ in range(60)]  # 120 KB each
    index = lk.ItemIndex(items)
    tracemalloc.start()
    for _ in index.search(docs):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
