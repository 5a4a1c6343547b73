"""Visually identical text with different characters: one consistent form.

The quick-check property sorts texts and, inside a text, places: a text without any unstable place is passed on
untouched and never leaves the JVM. Of the others only the unstable segments, each with the base letter before it
and the marks behind it, are normalized and spliced back between the unchanged rest.

Unstable are: width, style and ligature variants of letters, digits and signs; a letter followed by an accent it
has a composed form with; invisible characters; spaces other than the ordinary one (tab and line breaks are
ordinary); letters of another script next to a Latin letter. Kept, as they carry a meaning of their own: signs of
power, unit and fraction, dashes, comparison signs, whole accented letters, Greek symbols, words of other scripts,
joiners between letters of scripts that need them.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Compatibility classes of the Unicode character database that count as variants of the plain character.
VARIANT_TAGS = ("<wide>", "<narrow>", "<font>", "<circle>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Signs of a meaning of their own that normalization would lose (units; besides all powers and fractions).
KEPT_SIGNS = "µ℃℉ΩKÅ…‑"
#: Letters of other scripts and, below them, the Latin letters they look like, after the Unicode consortium's
#: public table of confusable characters (case kept; small letters in the form of a capital count as that letter). Greek
#: letters that are symbols in scientific words (as in TNF-alpha) are no look-alikes.
LOOKALIKES = {
    a: b
    for letters, latin in (
        ("АВЕЅІЈКМНОРСТУХѴҮӀԌԜЬ", "ABESIJKMHOPCTYXVYIGWb"),  # Cyrillic
        ("авгеҽѕіӏјкмнорстухүһѵѡԁԛԝꙇ", "abreesiljkmhopctyxyhvwdqwi"),
        ("ΑΒΕϜΖΗΙͿΚΜϺΝΟΡΤΥΧ", "ABEFZHIJKMMNOPTYX"),  # Greek
        ("ϳονι", "jovi"),
        ("ՍՏՕաոռսցհզքօ", "USOwnnughqfo"),  # Armenian
        ("ᎠᎡᎢᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏒᏔᏕᏙᏚᏞᏟᏢᏦᏳᏴ", "DRTYAJEWMHYGZRWSVSLCPKGB"),  # Cherokee
        ("ꭵꮁꮃꮓꮩꮪꮯᎥᏂᏏᏧ", "irwzvscihbd"),
        ("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⳐ", "HIKMNOPCTYXL"),  # Coptic
        ("ⲅⲟⲣⲥ", "ropc"),
    )
    for a, b in zip(letters, latin, strict=True)
}
#: Scripts with letters that look like Latin ones.
OTHER_SCRIPTS = ("Cyrillic", "Greek", "Armenian", "Cherokee", "Coptic")
#: Greek letters that stand before or behind a Latin letter as part of a unit.
UNIT_GREEK = "μΩ"


@functools.cache
def unstable_points() -> tuple[frozenset, frozenset, frozenset]:
    """Code points of variants, of invisible characters and of spaces, by rule from the character database."""
    variant, hidden, space = set(), set(), set()
    for p in range(sys.maxunicode + 1):
        c = chr(p)
        cat = unicodedata.category(c)
        if cat == "Zs" and c != " ":
            space.add(p)
        elif cat == "Cf" or cat == "Cc" and c not in "\t\n\r\x85" or 0xFE00 <= p <= 0xFE0F or p in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0):
            hidden.add(p)
        elif c not in KEPT_SIGNS and (d := unicodedata.decomposition(c)).startswith("<"):
            tag = d.split(" ")[0]
            if tag in VARIANT_TAGS or tag == "<compat>" and cat[0] in "LN":
                variant.add(p)
    return frozenset(variant), frozenset(hidden), frozenset(space)


def _cls(points, esc) -> str:
    """A character class body of code points as ranges; esc writes one code point."""
    out, ps = [], sorted(points)
    i = 0
    while i < len(ps):
        k = i
        while k + 1 < len(ps) and ps[k + 1] == ps[k] + 1:
            k += 1
        out.append(esc(ps[i]) if i == k else f"{esc(ps[i])}-{esc(ps[k])}")
        i = k + 1
    return "".join(out)


@functools.cache
def composing() -> dict[int, frozenset]:
    """Mark -> base letters with which it has a composed form."""
    out: dict[int, set] = {}
    for p in range(sys.maxunicode + 1):
        d = unicodedata.decomposition(chr(p))
        if d and d[0] != "<":
            parts = [int(x, 16) for x in d.split()]
            if len(parts) == 2 and unicodedata.normalize("NFC", chr(parts[0]) + chr(parts[1])) == chr(p):
                out.setdefault(parts[1], set()).add(parts[0])
    return {m: frozenset(b) for m, b in out.items() if unicodedata.category(chr(m)) == "Mn"}


def _java(p: int) -> str:
    return f"\\x{{{p:x}}}"


@functools.cache
def quick_pattern() -> str:
    """The quick check as a pattern for the JVM: finds something in every text with an unstable place. All large classes
    stand behind a test for plain ASCII, so that ordinary text is passed at one comparison a character."""
    variant, hidden, space = unstable_points()
    other = "".join(f"\\p{{Is{s}}}" for s in OTHER_SCRIPTS)
    other = f"[{other}&&[^{UNIT_GREEK}]]"
    marks = _cls(composing(), _java)
    return f"[^\\n\\x20-\\x7e](?<=[{_cls(variant | hidden | space, _java)}]|\\p{{L}}[{marks}]|{other}(?=\\p{{IsLatin}})|\\p{{IsLatin}}{other})"


@functools.cache
def _python_patterns():
    variant, hidden, space = unstable_points()
    esc = lambda p: f"\\U{p:08x}"
    bad = _cls(variant | hidden | space, esc)
    marks = _cls(composing(), esc)
    other = "[" + "".join(f"\\p{{{s}}}" for s in OTHER_SCRIPTS) + f"--[{UNIT_GREEK}]]"
    segment = regex.compile(f"[{bad}{marks}]+\\p{{M}}*", regex.V1)
    pair = regex.compile(f"{other}(?:(?=\\p{{Latin}})|(?<=\\p{{Latin}}.))", regex.V1)
    mixed = regex.compile(f"[\\p{{L}}\\p{{M}}]*(?:\\p{{Latin}}{other}|{other}\\p{{Latin}})[\\p{{L}}\\p{{M}}]*", regex.V1)
    joins = regex.compile(r"[\p{Arabic}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Khmer}\p{Mongolian}\p{Extended_Pictographic}]")
    return segment, pair, mixed, joins, variant, hidden, space


@functools.cache
def _plain(p: int) -> str:
    return unicodedata.normalize("NFKC", chr(p))


def canonical(text: str) -> tuple[str, int]:
    """The text in its one form and the number of unstable segments it had."""
    segment, pair, mixed, joins, variant, hidden, space = _python_patterns()
    count = 0
    pieces, at = [], 0
    for m in segment.finditer(text):
        s = m.start()
        # boundary context: the letter that a mark at the segment's start belongs to
        base = 1 if s > at and text[s - 1].isalpha() else 0
        pieces.append(text[at : s - base])
        out, cases = [text[s - base : s]], 0
        for i, c in enumerate(m.group()):
            p = ord(c)
            if p in hidden:
                if p in (0x200C, 0x200D, 0xFE0F) and joins.match(text[max(0, s + i - 1) : s + i]):
                    out.append(c)
                    continue
                cases += 1
            elif p in space:
                out.append(" ")
                cases += 1
            elif p in variant:
                out.append(_plain(p))
                cases += 1
            else:
                out.append(c)
        new = unicodedata.normalize("NFC", joined := "".join(out))
        count += bool(cases or new != joined)
        pieces.append(new)
        at = m.end()
    done = "".join((*pieces, text[at:])) if at else text

    def word(m) -> str:
        nonlocal count
        count += 1
        return "".join(LOOKALIKES.get(c, c) for c in m.group())

    if pair.search(done):
        done = mixed.sub(word, done)
    return done, count


def unstable(c: Column) -> Column:
    """The quick check: False for null and for texts that hold no unstable place."""
    return F.coalesce(c.rlike(quick_pattern()), F.lit(False))


_CANONICAL = T.StructType([T.StructField("text", T.StringType()), T.StructField("segments", T.IntegerType())])


@F.pandas_udf(_CANONICAL)
def _canonical_udf(texts: pd.Series) -> pd.DataFrame:
    done = [canonical(t) if t is not None else (None, 0) for t in texts]
    return pd.DataFrame({"text": [d[0] for d in done], "segments": [d[1] for d in done]})


def canonical_text(df: DataFrame, col: str, out: str = "canonical", segments: str = "segments") -> DataFrame:
    """df with the column's canonical text and the number of segments that had to be changed (0: the same text).

    Null stays null with 0 segments, an empty text stays empty. Only unstable texts are handed to Python. Narrow: no shuffle.
    """
    base = [c for c in df.columns if c not in (out, segments)]
    picked = df.withColumn("__u", _canonical_udf(F.when(unstable(F.col(col)), F.col(col))))
    return picked.select(*base, F.coalesce(F.col("__u.text"), F.col(col)).alias(out), F.coalesce(F.col("__u.segments"), F.lit(0)).alias(segments))


def unstable_rows(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(table_name, row_id) of the rows with at least one unstable segment; tables: name -> (rows, id column, text column)."""
    out = None
    for name, (df, rid, col) in tables.items():
        rows = df.select(F.col(rid).alias("row_id"), F.col(col).alias("txt")).where(unstable(F.col("txt")))
        one = canonical_text(rows, "txt").where("segments > 0").select(F.lit(name).alias("table_name"), "row_id")
        out = one if out is None else out.unionByName(one)
    return out
