"""Evaluation passages leaking into a corpus: q-gram lemma filtering and banded alignment.

Texts are brought to one form (characters, case, markup, punctuation, spacing). The q-grams that begin at word
starts are looked up in the index of the items' q-grams; hits are counted in overlapping bands of diagonals
(document offset less item offset). Edits of words move what follows by any number of characters, but by one word each:
where edits are allowed, hits are also counted in bands of word diagonals as wide as the edits. By the q-gram lemma a
stretch of `words` words with at most `edits` edits keeps a known number of its q-grams in one band, so bands below
that are dropped without losing any; the rest are verified by an alignment inside the band, of many pairs at once: where
no edit is allowed, along its diagonals. Documents are handled where they lie: nothing is shuffled.

Memory is bounded whatever texts share: documents are taken by characters, their hits by number, and a document with more
hits than that by ranges of items. Passages that are copies of each other are searched for once.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm import chars
from statloom.llm.subjects import powers
from statloom.runtime import written

Q = 16
WORDS = 13
#: Width of a band of character diagonals; bands overlap by half.
BAND = 32
#: What one step of an alignment's score weighs; the equal words are counted below it.
UNIT = 1 << 28
#: Characters of passages that one index may hold; more items are taken in blocks, each held against all documents.
BLOCK_CHARS = 20_000_000
#: Characters of documents, hits of q-grams, and cells of alignments that are handled at once.
TEXT_CHARS, HITS, CELLS = 1_000_000, 2_000_000, 1_000_000
FOUND = "doc_id long, item_id long, run_words int, aligned_words int, edits int"

#: What counts as markup between or around words.
MARKUP = r"</?[A-Za-z][^<>]*>|<!--|-->|&#?[A-Za-z0-9]{1,8};|\\[A-Za-z]+\*?"


def plain_words(c: Column) -> Column:
    """Lower-case words with single spaces, for texts without unstable characters."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(c, MARKUP, " ")), r"[^\p{L}\p{Nd}]+", " "))


@functools.cache
def _patterns():
    return regex.compile(MARKUP), regex.compile(r"[^\p{L}\p{Nd}]+")


def plain_words_of(text: str) -> str:
    """The same of any text, in Python."""
    markup, other = _patterns()
    return other.sub(" ", markup.sub(" ", chars.canonical(text)[0]).lower()).strip(" ")


def _grams(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the Q bytes from each position; b must go on for Q bytes behind the last."""
    eight = np.ndarray((len(b) - 7,), dtype="<u8", buffer=b, strides=(1,))
    x, y = eight[at], eight[at + 8]
    h = x * np.uint64(0x9E3779B97F4A7C15) + (y ^ (y >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def _words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and a hash of each."""
    space = b == 32
    s = np.flatnonzero(~space[1:] & space[:-1]) + 1
    e = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    up, down = powers(max(1 << 16, 1 << int(len(b)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)])
    h = (sums[e] - sums[s]) * down[s]
    h ^= h >> np.uint64(31)
    return s, h * np.uint64(0xD6E8FEB86659FD93)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, with room for a q-gram between them, and where each begins."""
    parts = [b" " + t.encode() + b" " * (Q + 1) for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts) + b" " * Q, dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def _flat(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... n[k] of each, one after another."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive entries of at most `most` in sum; an entry beyond that is a range of its own."""
    upto, a = np.cumsum(sizes), 0
    while a < len(sizes):
        z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, side="right")))
        yield a, z
        a = z


def _sorted(p: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """The three arrays of small numbers from 0, in their order; by one sort of one number where they fit in it."""
    if not len(p):
        return p, x, y
    bp, bx, by = (int(v.max()).bit_length() for v in (p, x, y))
    if bp + bx + by > 63:
        o = np.lexsort((y, x, p))
        return p[o], x[o], y[o]
    k = np.sort((p << (bx + by)) | (x << by) | y)
    return k >> (bx + by), (k >> by) & ((1 << bx) - 1), k & ((1 << by) - 1)


class ItemIndex:
    """The q-grams of the items' passages, with the lemma's threshold of each different passage."""

    def __init__(self, items: list[tuple[int, str]], words: int = WORDS, edits: int = 0):
        self.words, self.edits = words, edits
        of_text: dict[str, list[int]] = {}
        for i, t in items:
            of_text.setdefault(t, []).append(i)
        texts = list(of_text) or [""]  # an index of nothing finds nothing
        self.copies = np.array([len(of_text.get(t, ())) for t in texts], dtype=np.int64)
        self.ids = np.array([i for v in of_text.values() for i in v], dtype=np.int64)
        self.first_id = np.cumsum(self.copies) - self.copies
        b, starts = _joined(texts)
        ws, self.hashes = _words(b)
        item = np.searchsorted(starts, ws, side="right") - 1
        self.first = np.searchsorted(ws, starts)
        self.size = np.diff(np.append(self.first, len(ws)))
        length = np.array([len(t.encode()) for t in texts], dtype=np.int64)
        offset = ws - starts[item] - 1 if len(ws) else ws
        whole = offset + Q <= length[item] if len(ws) else np.zeros(0, bool)
        g = _grams(b, ws[whole])
        o = np.argsort(g, kind="stable")
        self.grams, first = np.unique(g[o], return_index=True)
        self.cut = np.append(first, len(g)).astype(np.int64)
        self.item = item[whole][o].astype(np.int64)
        self.offset = offset[whole][o]
        self.word = (np.arange(len(ws)) - self.first[item])[whole][o] if len(ws) else offset
        # postings of a q-gram are in order of items: this finds those of a range of items
        self.place = np.repeat(np.arange(len(self.grams)), np.diff(self.cut)) * (len(texts) + 1) + self.item
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[(self.grams >> np.uint64(42)).astype(np.int64)] = True
        self.least = np.array([self._threshold(offset[f : f + n], length[k]) for k, (f, n) in enumerate(zip(self.first, self.size, strict=True))], dtype=np.int64)

    def _threshold(self, at: np.ndarray, length: int) -> int:
        """Fewest q-grams that any stretch of `words` words keeps, less those that the edits can destroy. at: where the
        words of a passage begin."""
        if not len(at):
            return 1
        n = min(self.words, len(at))
        end = np.append(at[1:] - 1, length)
        first = np.arange(len(at) - n + 1)
        inside = np.searchsorted(at, end[first + n - 1] - Q, side="right") - first
        # word starts whose q-gram reaches one word: those within Q bytes before its end
        destroyed = int((np.searchsorted(at, at + Q + (end - at) + 1, side="left") - np.arange(len(at))).max())
        return max(1, int(inside.min()) - self.edits * destroyed)

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, place of the item in ids, longest run of words, aligned words, edits) of every pair that passes the filter."""
        return [tuple(map(int, r)) for part in self.search(texts) for r in zip(*part, strict=True)]

    def search(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """The same as arrays, part by part."""
        if not texts or not len(self.grams):
            return
        for a, z in _parts(np.array([len(t) + 1 for t in texts]), TEXT_CHARS):
            for doc, item, *figures in self._search(texts[a:z]):
                n = self.copies[item]
                yield np.repeat(doc + a, n), _flat(self.first_id[item], n), *(np.repeat(x, n) for x in figures)

    def _search(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        b, starts = _joined(texts)
        ws, hashes = _words(b)
        first = np.searchsorted(ws, starts)
        size = np.diff(np.append(first, len(ws)))
        h = _grams(b, ws)
        maybe = np.flatnonzero(self.bits[(h >> np.uint64(42)).astype(np.int64)])
        g = h[maybe]
        slot = np.searchsorted(self.grams, g)
        slot[slot == len(self.grams)] = 0
        same = self.grams[slot] == g
        maybe, slot = maybe[same], slot[same]
        if not len(maybe):
            return
        doc = np.searchsorted(starts, ws[maybe], side="right") - 1
        of_doc = np.searchsorted(doc, np.arange(len(texts) + 1))
        n = self.cut[slot + 1] - self.cut[slot]
        sums = np.concatenate([[0], np.cumsum(n)])
        for a, z in _parts(sums[of_doc[1:]] - sums[of_doc[:-1]], HITS):
            at = slice(of_doc[a], of_doc[z])
            total, items = int(n[at].sum()), len(self.size)
            ranges = -(-total // HITS) if z - a == 1 else 1
            for k in range(ranges):  # a document of very many hits: some items after others
                lo, hi = self.cut[slot[at]], self.cut[slot[at] + 1]
                if ranges > 1:
                    key = slot[at] * (items + 1)
                    lo, hi = (np.searchsorted(self.place, key + items * x // ranges) for x in (k, k + 1))
                m = hi - lo
                if m.sum():
                    word, posting = np.repeat(maybe[at], m), _flat(lo, m)
                    found = self._bands(np.repeat(doc[at], m), self.item[posting], ws[word] - starts[np.repeat(doc[at], m)] - 1 - self.offset[posting], word - first[np.repeat(doc[at], m)] - self.word[posting])
                    yield from self._verified(*found, hashes, first, size)

    def _bands(self, doc: np.ndarray, item: np.ndarray, diagonal: np.ndarray, in_words: np.ndarray) -> tuple[np.ndarray, ...]:
        """(doc, item, first and last word diagonal) of the bands that hold enough hits; where no edit is allowed, of each
        word diagonal in them."""
        pair, least_word = doc * len(self.size) + item, in_words.min()
        diagonal, in_words = diagonal - diagonal.min(), in_words - least_word
        out = []
        p, x, w = _sorted(pair, diagonal, in_words)
        bands = [(p, w, (x + shift) // BAND) for shift in (0, BAND // 2)]
        if self.edits:  # any edits + 1 neighbouring word diagonals share one of these
            p, w, _ = _sorted(pair, in_words, np.zeros_like(pair))
            bands += [(p, w, (w + shift) // (2 * self.edits)) for shift in (0, self.edits)]
        for p, w, band in bands:
            new = np.ones(len(p), dtype=bool)
            new[1:] = (p[1:] != p[:-1]) | (band[1:] != band[:-1])
            at = np.flatnonzero(new)
            many = np.diff(np.append(at, len(p))) >= self.least[p[at] % len(self.size)]
            if self.edits:
                out.append((p[at][many], np.minimum.reduceat(w, at)[many], np.maximum.reduceat(w, at)[many]))
            else:
                held = np.repeat(many, np.diff(np.append(at, len(p))))
                out.append((p[held], w[held], w[held]))
        p, lo, hi = _sorted(*(np.concatenate(x) for x in zip(*out, strict=True)))
        new = np.ones(len(p), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        p, lo, hi = p[new], lo[new] + least_word, hi[new] + least_word
        return p // len(self.size), p % len(self.size), lo, hi

    def _verified(self, doc, item, lo, hi, hashes, first, size) -> Iterator[tuple[np.ndarray, ...]]:
        """(doc, item, run, aligned, edits) of each pair's best band."""
        cost = self.size[item] * (hi - lo + 1)
        pair = doc * len(self.size) + item
        left = None
        for a, z in _parts(cost, CELLS):
            args = (doc[a:z], item[a:z], lo[a:z], hi[a:z], hashes, first, size)
            figures = self._aligned(*args) if self.edits else self._runs(*args)
            rows = np.stack([pair[a:z], *figures])
            rows = rows if left is None else np.concatenate([left, rows], axis=1)
            rows = rows[:, np.lexsort(rows[::-1])]
            best = rows[:, np.append(np.diff(rows[0]) != 0, True)]
            # the last pair may go on in the next part
            best, left = (best[:, :-1], best[:, -1:]) if z < len(doc) else (best, None)
            if best.shape[1]:
                yield best[0] // len(self.size), best[0] % len(self.size), *best[1:]

    def _runs(self, doc, item, diagonal, _, hashes, first, size):
        """The longest run of equal words on one diagonal of each pair: its alignment without edits."""
        n = self.size[item]
        starts = np.cumsum(n) - n
        j = _flat(np.zeros_like(n), n)
        at = j + np.repeat(diagonal, n)
        inside = (at >= 0) & (at < np.repeat(size[doc], n))
        place = np.where(inside, at + np.repeat(first[doc], n), 0)
        equal = inside & (hashes[place] == self.hashes[j + np.repeat(self.first[item], n)])
        upto = np.cumsum(equal)
        base = np.where(equal, -1, upto)
        base[starts] = np.maximum(base[starts], upto[starts] - equal[starts])
        run = np.maximum.reduceat(upto - np.maximum.accumulate(base), starts)
        return run, run, np.zeros_like(run)

    def _aligned(self, doc, item, lo, hi, hashes, first, size):
        """Inside the band of word diagonals lo-slack..hi+slack of each pair: the longest run of equal words, and of the best
        local alignment (+1 an equal word, -1 an edit) its equal words and edits."""
        slack = max(2, self.edits)
        lo, width, n = lo - slack, hi - lo + 1 + 2 * slack, self.size[item]
        steps = np.arange(int(width.max()))
        inside = steps < width[:, None]
        run = np.zeros(inside.shape, dtype=np.int64)
        # score * UNIT + equal words: the better score, then the longer alignment
        row = np.zeros((len(doc), len(steps) + 1), dtype=np.int64)
        best_run, best = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        for j in range(int(n.max())):
            at = lo[:, None] + steps + j
            there = inside & (at >= 0) & (at < size[doc][:, None]) & (j < n)[:, None]
            word = self.hashes[np.minimum(self.first[item] + j, len(self.hashes) - 1)]
            eq = there & (hashes[np.where(there, at + first[doc][:, None], 0)] == word[:, None])
            run = (run + 1) * eq
            step = np.maximum(row[:, :-1] + np.where(eq, UNIT + 1, -UNIT), row[:, 1:] - UNIT)
            step = np.maximum(step, 0)
            # a gap in the item: from the left, one off a step
            step = np.maximum(np.maximum.accumulate(step + UNIT * steps, axis=1) - UNIT * steps, 0)
            step *= inside & (j < n)[:, None]
            row[:, :-1] = step
            best_run, best = np.maximum(best_run, run.max(axis=1)), np.maximum(best, step.max(axis=1))
        equal = best % UNIT
        return best_run, equal, np.maximum(0, equal - best // UNIT)


def leaked(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", passage_col="passage", words: int = WORDS, edits: int = 0) -> DataFrame:
    """FOUND rows: every document and item of which a stretch of `words` words with at most `edits` edits is shared
    (run_words: the longest run letter for letter). Null ids and texts give nothing; an item shorter than `words` words is
    held against documents as a whole; repeated documents give their rows again.

    Only the items are gathered, in blocks of at most BLOCK_CHARS characters; each block is held against all documents.
    """
    picked = items.where(F.col(item_col).isNotNull() & F.col(passage_col).isNotNull())
    size = picked.agg(F.coalesce(F.sum(F.length(passage_col)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_CHARS))
    raw = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    # only texts with unstable characters are put into form in Python
    ready = raw.withColumn("odd", chars.unstable(F.col("txt"))).select("id", F.when(~F.col("odd"), plain_words(F.col("txt"))).alias("plain"), F.when(F.col("odd"), F.col("txt")).alias("odd"))
    if blocks > 1:
        ready = written(ready, "leak-texts")  # brought into form once, not once a block
    out = None
    for k in range(blocks):
        block = picked.where(F.pmod(F.xxhash64(item_col), F.lit(blocks)) == k).select(item_col, passage_col).distinct().collect()
        texts = [(int(r[0]), plain_words_of(r[1])) for r in block]
        blob = docs.sparkSession.sparkContext.broadcast(pickle.dumps([(i, t) for i, t in texts if t]))
        one = ready.mapInPandas(_searcher(blob, words, edits), FOUND)
        out = one if out is None else out.unionByName(one)
    return out


def _searcher(blob, words: int, edits: int):
    names = [c.split(" ")[0] for c in FOUND.split(", ")]

    def search(batches):
        index = None
        for pdf in batches:
            if index is None:
                index = _index(blob, words, edits)
            texts = [p if p is not None else plain_words_of(o) for p, o in zip(pdf["plain"], pdf["odd"], strict=True)]
            ids = pdf["id"].to_numpy()
            for doc, item, *figures in index.search(texts):
                yield pd.DataFrame(dict(zip(names, (ids[doc], index.ids[item], *figures), strict=True)))

    return search


_indexes: dict = {}


def _index(blob, words: int, edits: int) -> ItemIndex:
    """Built once in a worker, not once a task."""
    key = (hash(blob.value), words, edits)
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = ItemIndex(pickle.loads(blob.value), words, edits)
    return _indexes[key]
