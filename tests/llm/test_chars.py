import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

from statloom.llm import chars
from tests.helpers import rows

UNSTABLE = [("ｗｉｄｅ", "wide"), ("𝐩 = 0.5", "p = 0.5"), ("ﬁne", "fine"), ("n = １８７", "n = 187"), ("e\u0301t", "ét"), ("a\u200bb", "ab"), ("so\u00adft", "soft"), ("a\u00a0b", "a b"), ("a\u3000b", "a b"), ("bl\u043eck", "block"), ("m\u03bfde", "mode"), ("\u03b7\u0301", "ή"), ("ｅ\u0301", "é"), ("ＣＩ：９５％", "CI:95%")]
STABLE = ["é ñ Ö", "η² = 0.4, β and χ²", "Κλινική μελέτη", "Отдел", "40 µg at 37 °C, ½ dose", "p ≤ 0.05 – or − 3", "tab\tline\nbreak\r\n", "", "5 μm and kΩ", "x\u0304 bar" if unicodedata.normalize("NFC", "x\u0304") == "x\u0304" else "x"]


@pytest.mark.parametrize("text, want", UNSTABLE)
def test_unstable(text, want):
    got, n = chars.canonical(text)
    assert got == want and n >= 1
    assert chars.canonical(got) == (want, 0)


@pytest.mark.parametrize("text, want", [("кitten", "kitten"), ("гun", "run"), ("Ꭺbc", "Abc"), ("mеthоd", "method"), ("sоաer", "sower"), ("Ⲕey", "Key"), ("нouse", "house")])
def test_look_alikes_of_all_scripts(text, want):
    assert chars.canonical(text) == (want, 1) and chars.canonical(want) == (want, 0)


def test_every_look_alike_is_settled_at_once():
    assert len(chars.LOOKALIKES) > 120
    for c, latin in chars.LOOKALIKES.items():
        assert latin.isascii() and chars.canonical(f"a{c}a") == (f"a{latin}a", 1)
        assert chars.canonical(f"{c}{c}") == (f"{c}{c}", 0)  # a word of its own script stays
    for word in ("TNFα", "IFNγ", "NFκB"):
        assert chars.canonical(word)[0] == word


@pytest.mark.parametrize("text", STABLE)
def test_stable(text):
    assert chars.canonical(text) == (text, 0)


def test_joiners_keep_their_meaning():
    for text in ("می\u200cخواهم", "क\u094d\u200dष", "👩\u200d🔬"):
        assert chars.canonical(text)[0] == text


def test_quick_check_agrees(spark):
    texts = [t for t, _ in UNSTABLE] + STABLE + [None, "long " * 50_000 + "ﬁ"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, t string, segments string")
    got = chars.canonical_text(df, "t").orderBy("id").collect()
    assert [r["segments"] > 0 for r in got] == [True] * len(UNSTABLE) + [False] * len(STABLE) + [False, True]
    assert [r["canonical"] for r in got[: len(UNSTABLE)]] == [w for _, w in UNSTABLE]
    assert rows(chars.unstable_rows({"a": (df, "id", "t")})) == sorted([("a", i) for i in range(len(UNSTABLE))] + [("a", len(texts) - 1)])
    assert chars.unstable_rows({"a": (df.limit(0), "id", "t")}).count() == 0


ALPHABET = "abz .,0é" + "ﬁＡ１\u0301\u00a0\u200b\u043e\u03bfηЖ²½µ"


@given(st.text(ALPHABET, max_size=30))
def test_idempotent(text):
    once = chars.canonical(text)[0]
    again = chars.canonical(once)[0]
    assert chars.canonical(again)[0] == again
    if not text.isascii() or text:
        assert chars.canonical(text)[1] or once == text
