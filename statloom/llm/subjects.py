"""Subject areas of documents: interpolated n-gram language models, subject against background.

One bigram model is trained per subject and one for held-out passages, which carry no subject of the document they
stand in. A sentence's per-token cross-entropy under each subject's model is held against that of its background
model, the other subjects; the gain, summed over the sentence, says whether it bears a subject and which. A
document is accepted for every subject that a calibrated share of its subject-bearing sentences deals with.

The models are trained on a bounded sample of the labelled documents (MAX_LABELLED); scoring covers every document
and is narrow: each is scored where it lies.
"""

from __future__ import annotations

import functools
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm import chars
from statloom.runtime import written

#: Labelled documents, taken by hash of their id, that models are trained on.
MAX_LABELLED = 3000
#: Characters of these documents together: in the order of the hash, one that would lift the sum over it is passed over.
MAX_CHARS = 20_000_000
#: Characters of held-out passages. All of them are trained on; more are refused, never left out.
MAX_PASSAGE_CHARS = 20_000_000
#: Pseudo-counts with which a bigram falls back on the unigram, and a unigram on the uniform model.
KAPPA, ALPHA = 1000.0, 3.0
#: Gain or loss of a single word, in nats, that may be chance and is taken off every word's.
NOISE = 1.5
#: Gain over the background from which a sentence bears a subject; share of such sentences that makes a subject.
BEARING, SHARE = 1.0, 0.3

_NUMBER, _BREAK, _OTHER = r"\p{Nd}+(?:[.,]\p{Nd}+)*", r"\n(?=[ \t]*\p{Ll})", r"[^\p{L}\p{Nd}.!?\n]+"


def reduced(c: Column) -> Column:
    """Lower-case words, numbers as 0, sentence ends and line breaks kept; for texts without unstable characters."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, _NUMBER, "0"), _BREAK, " "), _OTHER, " "))


@functools.cache
def _patterns():
    return regex.compile(_NUMBER), regex.compile(_BREAK), regex.compile(_OTHER)


def reduced_of(text: str) -> str:
    number, brk, other = _patterns()
    return other.sub(" ", brk.sub(" ", number.sub("0", chars.canonical(text)[0]))).lower()


@dataclass
class Words:
    """All words of some texts, in order: hash, sentence, and for each sentence its text and whether it is whole."""

    hashes: np.ndarray
    sentence: np.ndarray
    starts: np.ndarray
    text: np.ndarray
    whole: np.ndarray


_B = 0x9E3779B97F4A7C15
_B_INV = pow(_B, -1, 1 << 64)


@functools.cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _B, np.uint64)]))
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _B_INV, np.uint64)]))
    return up, down


#: Characters that are hashed at once; more are taken in parts, which bounds the memory of what stands in between.
SPLIT_CHARS = 1_000_000


def split_words(texts: list[str]) -> Words:
    """Words of reduced texts. A line that doesn't end as a sentence (a title, a heading) is not whole."""
    if len(texts) > 1 and sum(map(len, texts)) > SPLIT_CHARS:
        cuts, n = [0], 0
        for i, t in enumerate(texts):
            if n and n + len(t) > SPLIT_CHARS:
                cuts.append(i)
                n = 0
            n += len(t)
        parts = [(a, _split(texts[a:b])) for a, b in zip(cuts, [*cuts[1:], len(texts)], strict=True)]
        words = np.cumsum([0, *(len(w.hashes) for _, w in parts)])
        sentences = np.cumsum([0, *(len(w.starts) for _, w in parts)])
        join = lambda f: np.concatenate([f(i, a, w) for i, (a, w) in enumerate(parts)])
        return Words(join(lambda i, a, w: w.hashes), join(lambda i, a, w: w.sentence + sentences[i]), join(lambda i, a, w: w.starts + words[i]), join(lambda i, a, w: w.text + a), join(lambda i, a, w: w.whole))
    return _split(texts)


def _split(texts: list[str]) -> Words:
    parts = [b" " + t.encode() + b"\n" for t in texts]
    b = np.frombuffer(b"".join(parts) + b" ", dtype=np.uint8)
    ends_of = np.cumsum(np.array([len(p) for p in parts], dtype=np.int64)) if parts else np.zeros(0, np.int64)
    sep = (b == 32) | (b == 46) | (b == 33) | (b == 63) | (b == 10)
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    s, e = edge[::2], edge[1::2]
    cut = np.flatnonzero(sep & (b != 32))
    up, down = powers(max(1 << 16, 1 << int(len(b)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)])
    h = (sums[e] - sums[s]) * down[s]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    where = np.searchsorted(cut, s)
    used, starts, sentence = np.unique(where, return_index=True, return_inverse=True)
    return Words(h, sentence, starts, np.searchsorted(ends_of, cut[used], side="right"), b[cut[used]] != 10)


class Table:
    """Distinct 64-bit keys -> rows, by one probe of an array and one comparison."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        bits = max(12, int(4 * len(self.keys)).bit_length())
        while True:
            slots = np.full(1 << bits, -1, dtype=np.int32)
            at = (self.keys * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)
            slots[at.astype(np.int64)] = np.arange(len(self.keys))
            left = int((slots >= 0).sum())
            if left >= 0.9 * len(self.keys) or bits >= 26:
                break
            bits += 1
        self.slots, self.bits = slots, bits
        lost = slots[at.astype(np.int64)] != np.arange(len(self.keys))
        self.rest = np.flatnonzero(lost)
        self.rest_keys = self.keys[self.rest]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        if not len(self.keys) or not len(keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = ((keys * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - self.bits)).astype(np.int64)
        row = self.slots[at].astype(np.int64)
        wrong = np.flatnonzero((row >= 0) & (self.keys[row] != keys))
        row[wrong] = -1
        if len(wrong) and len(self.rest):
            k = np.searchsorted(self.rest_keys, keys[wrong])
            k[k == len(self.rest)] = 0
            hit = self.rest_keys[k] == keys[wrong]
            row[wrong[hit]] = self.rest[k[hit]]
        return row


_PAIR = np.uint64(0xA24BAED4963EE407)


def _pairs(w: Words) -> np.ndarray:
    """Hash of each word with the one before it in its sentence; the first word's pair begins with the sentence."""
    before = np.concatenate([np.zeros(1, np.uint64), w.hashes[:-1]]) if len(w.hashes) else w.hashes
    before[w.starts] = 0
    return (before * _PAIR) ^ w.hashes, before


class Models:
    """Interpolated bigram models of the subjects and of held-out passages, each held against its own background: the
    other subjects in equal parts (for held-out passages, all subjects). So neither the number of subjects nor their
    frequencies limit what a word can gain."""

    def __init__(self, w: Words, weights: np.ndarray):
        """weights: how much each sentence counts for each class, (sentences, classes); the last class is held-out text."""
        size = np.bincount(w.sentence, minlength=len(w.starts))
        tokens = weights.T @ size
        full = tokens[:-1][tokens[:-1] > 0]
        mean = full.mean() if len(full) else 1.0
        weights = weights * np.where(tokens > 0, mean / np.maximum(tokens, 1e-9), 0)
        pair, before = _pairs(w)
        self.words, self.pairs = Table(w.hashes), Table(pair)
        n = weights.shape[1]
        of_word, of_pair, of_before = self.words.find(w.hashes), self.pairs.find(pair), self.words.find(before)
        uni, bi = np.zeros((len(self.words.keys), n)), np.zeros((len(self.pairs.keys), n))
        hist, start = np.zeros((len(self.words.keys), n)), np.zeros((1, n))
        known = of_before >= 0
        for c in range(n):
            per = weights[w.sentence, c]
            uni[:, c] = np.bincount(of_word, per, len(uni))
            bi[:, c] = np.bincount(of_pair, per, len(bi))
            hist[:, c] = np.bincount(of_before[known], per[known], len(hist))
            start[0, c] = per[~known].sum()
        word_of_pair, hist_of_pair = np.zeros(len(bi), np.int64), np.full(len(bi), -1)
        word_of_pair[of_pair], hist_of_pair[of_pair] = of_word, of_before

        def logs(u, b, h, s):
            p1 = (u + ALPHA) / (u.sum(axis=0) + ALPHA * (len(u) + 1))
            before_pair = np.where((hist_of_pair >= 0)[:, None], h[np.maximum(hist_of_pair, 0)], s) if len(h) else np.broadcast_to(s, b.shape)
            p2 = (b + KAPPA * (p1[word_of_pair] if len(p1) else 0)) / (before_pair + KAPPA)
            return np.log(p1), np.log(p2), np.log(KAPPA / (h + KAPPA)), np.log(KAPPA / (s + KAPPA))

        own = logs(uni, bi, hist, start)
        against = logs(*(self._background(x) for x in (uni, bi, hist, start)))
        self.uni, self.bi, self.hist, self.start = ((x - y).astype(np.float32) for x, y in zip(own, against, strict=True))

    @staticmethod
    def _background(x: np.ndarray) -> np.ndarray:
        subjects = x[:, :-1]
        n = subjects.shape[1]
        total = subjects.sum(axis=1, keepdims=True)
        return np.hstack([(total - subjects) / max(1, n - 1), total / max(1, n)]).clip(min=0)

    def gains(self, w: Words, noise: float | None = None) -> np.ndarray:
        """(sentences, classes): nats by which each model beats its background. A word no model knows says nothing."""
        if not len(w.hashes) or not len(self.uni):  # no words, or a model of none
            return np.zeros((len(w.starts), self.uni.shape[1]), np.float32)
        pair, before = _pairs(w)
        of_pair = self.pairs.find(pair)
        seen = of_pair >= 0
        out = np.empty((len(w.hashes), self.uni.shape[1]), np.float32)
        out[seen] = self.bi[of_pair[seen]]
        rest = np.flatnonzero(~seen)
        of_word, of_before = self.words.find(w.hashes[rest]), self.words.find(before[rest])
        known = of_word >= 0
        part = np.where(known[:, None], self.uni[np.maximum(of_word, 0)], np.float32(0))
        # the history's part counts only where the word itself is known
        part += known[:, None] * np.where((of_before >= 0)[:, None], self.hist[np.maximum(of_before, 0)], np.where((before[rest] == 0)[:, None], self.start, np.float32(0)))
        out[rest] = part
        out = np.sign(out) * np.maximum(np.abs(out) - np.float32(NOISE if noise is None else noise), 0)
        return np.add.reduceat(out, w.starts, axis=0)


class SubjectClassifier:
    """Models of the subjects and of held-out passages, with calibrated acceptance."""

    def __init__(self, codes: list[str], models: Models, bearing: float = BEARING, share: float = SHARE):
        self.codes, self.models, self.bearing, self.share = codes, models, bearing, share

    def assign(self, w: Words) -> np.ndarray:
        """The subject of each sentence; -1 for those that bear none, stand in a held-out passage or aren't whole."""
        g = self.models.gains(w)
        if not len(g):
            return np.zeros(0, np.int64)
        subjects, held = g[:, :-1], g[:, -1]
        best = subjects.argmax(axis=1)
        top = subjects[np.arange(len(best)), best]
        return np.where((top >= self.bearing) & (held < top) & w.whole, best, -1)

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, subjects): sentences of each subject, and all subject-bearing sentences of each text."""
        w = split_words(texts)
        s = self.assign(w)
        ok = s >= 0
        n = len(self.codes)
        counts = np.bincount(w.text[ok] * n + s[ok], minlength=len(texts) * n).reshape(len(texts), n)
        return counts, counts.sum(axis=1)

    def accepted(self, texts: list[str]) -> list[tuple[int, int, float]]:
        counts, total = self.shares(texts)
        part = counts / np.maximum(total, 1)[:, None]
        return [(int(t), int(s), float(part[t, s])) for t, s in zip(*np.nonzero((part >= self.share) & (counts > 0)), strict=True)]


def train(labelled: list[tuple[str, list[str]]], passages: list[str], codes: list[str], rounds: int = 2) -> SubjectClassifier:
    """From (reduced text, its codes) of labelled documents and reduced held-out passages. Labels name documents, not
    sentences, and some are wrong: every whole sentence counts for its document's labels, first in equal parts, then in
    the parts its words speak for; sentences of held-out passages count for none. What all subjects share, or only
    strays into one, gains less than NOISE a word and so nothing."""
    texts = [t for t, _ in labelled] + passages
    w = split_words(texts)
    n = len(codes)
    allowed = np.zeros((len(texts), n), dtype=bool)
    for i, (_, own) in enumerate(labelled):
        for c in own:
            if c in codes:
                allowed[i, codes.index(c)] = True
    held = w.text >= len(labelled)
    may = allowed[w.text] & ~held[:, None] & w.whole[:, None]
    weights = np.zeros((len(w.starts), n + 1))
    weights[held, n] = 1
    weights[:, :n] = may / np.maximum(may.sum(axis=1), 1)[:, None]
    for _ in range(rounds - 1):
        g = Models(w, weights).gains(w, 0.0)
        own = np.where(may, g[:, :n], -np.inf)
        top = own.max(axis=1, keepdims=True, initial=-np.inf)
        part = np.exp(np.where(may, own - np.where(np.isfinite(top), top, 0), -np.inf))
        weights[:, :n] = part / np.maximum(part.sum(axis=1), 1e-9)[:, None] * (g[:, n] < 0)[:, None]
    return calibrated(SubjectClassifier(codes, Models(w, weights)), labelled)


def calibrated(model: SubjectClassifier, labelled: list[tuple[str, list[str]]], least: float = 0.26, most: float = 0.36) -> SubjectClassifier:
    """Sets the acceptance share, near a third, to where the labels agree best (F1 over all pairs)."""
    counts, total = model.shares([t for t, _ in labelled])
    truth = np.zeros(counts.shape, dtype=bool)
    for i, (_, own) in enumerate(labelled):
        for c in own:
            if c in model.codes:
                truth[i, model.codes.index(c)] = True
    part = counts / np.maximum(total, 1)[:, None]
    best = (-1.0, 0.0)
    for share in np.arange(least, most, 0.01):
        said = (part >= share) & (counts > 0)
        f1 = 2 * (said & truth).sum() / max(1, said.sum() + truth.sum())
        ranked = (round(float(f1), 4), -round(abs(float(share) - SHARE), 4))
        if ranked > best:
            best, model.share = ranked, float(share)
    return model


def fit(docs: DataFrame, labels: DataFrame, subjects: DataFrame, items: DataFrame | None = None, max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS) -> SubjectClassifier:
    """Trains on the driver from at most max_labelled labelled documents of max_chars characters, and all held-out passages.

    Of several rows of one id the shortest text is taken, and of those the first by hash. Lengths are looked at before any
    text is fetched, so what the driver gets is bounded whatever the documents are. Labels of which no document fits the
    bound, and passages beyond MAX_PASSAGE_CHARS, raise ValueError; without any labels there is a model of nothing.
    """
    codes = sorted({r[0] for r in subjects.select("subject_code").where("subject_code is not null").distinct().collect()})
    own = labels.where(F.col("subject_code").isin(codes)).groupBy("doc_id").agg(F.collect_set("subject_code").alias("codes"))
    pick = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)  # bounded, so it may be broadcast
    # one pass over the corpus; what is kept of it is small
    picked = written(docs.select("doc_id", "text").where("text is not null").join(F.broadcast(pick), "doc_id"), "labelled")
    which = F.struct(F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    left, taken, over = max_chars, [], 0
    for r in picked.groupBy("doc_id").agg(F.min(which).alias("r")).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "r.n", "r.h").collect():
        if r["n"] <= left:
            left -= r["n"]
            taken.append((r["doc_id"], r["h"]))
        else:
            over += 1
    if over and not taken:
        raise ValueError(f"no labelled document has at most max_chars = {max_chars} characters: there is nothing to train on")
    chosen = docs.sparkSession.createDataFrame(taken, "doc_id long, h long")  # at most max_labelled rows
    few = picked.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id"])
    few = few.withColumn("plain", F.when(~chars.unstable(F.col("text")), reduced(F.col("text"))))
    rows = few.select("doc_id", "codes", "plain", F.when(F.col("plain").isNull(), F.col("text")).alias("text")).collect()
    labelled = [(r["plain"] if r["plain"] is not None else reduced_of(r["text"]), sorted(r["codes"])) for r in sorted(rows, key=lambda r: r["doc_id"])]
    return train(labelled, _passages(items), codes)


def _passages(items: DataFrame | None) -> list[str]:
    if items is None:
        return []
    p = items.select("passage").where("passage is not null").distinct()
    size = p.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0)).alias("n")).first()["n"]
    if size > MAX_PASSAGE_CHARS:
        raise ValueError(f"{size} characters of held-out passages are more than MAX_PASSAGE_CHARS = {MAX_PASSAGE_CHARS}")
    return [reduced_of(t) for t in sorted(r[0] for r in p.collect())]


_models: dict = {}


def _unpickled(blob) -> SubjectClassifier:
    """Once in a worker, not once a task."""
    key = hash(blob.value)
    if key not in _models:
        _models.clear()
        _models[key] = pickle.loads(blob.value)
    return _models[key]


FOUND = "doc_id long, subject_code string, share double"


def document_subjects(docs: DataFrame, model: SubjectClassifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, subject_code, share of its subject-bearing sentences) of every document. Null, empty and boilerplate-only
    texts have none; repeated documents give their rows again."""
    blob = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    raw = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    ready = raw.withColumn("odd", chars.unstable(F.col("txt"))).select("id", F.when(~F.col("odd"), reduced(F.col("txt"))).alias("plain"), F.when(F.col("odd"), F.col("txt")).alias("odd"))

    def score(batches):
        m = _unpickled(blob)
        for pdf in batches:
            out = []
            ids = pdf["id"].to_list()
            for at in range(0, len(ids), 1000):
                texts = [p if p is not None else reduced_of(o) for p, o in zip(pdf["plain"][at : at + 1000], pdf["odd"][at : at + 1000], strict=True)]
                out += [(ids[at + t], m.codes[s], x) for t, s, x in m.accepted(texts)]
            yield pd.DataFrame(out, columns=["doc_id", "subject_code", "share"])

    return ready.mapInPandas(score, FOUND)


def composition(found: DataFrame) -> DataFrame:
    """Make-up of the corpus: documents of each subject, and their number if each counts once, shared by its subjects."""
    per = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("subject_code").alias("codes"))
    return per.select(F.explode("codes").alias("subject_code"), "n").groupBy("subject_code").agg(F.count(F.lit(1)).alias("documents"), F.sum(1 / F.col("n")).alias("shared_documents"))
