"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Terms of a text are its words (hashed), the shapes of its words (``Xx``, ``x,``, ``X!!``) and how often a word repeats the one before it.
Logarithmic counts are weighted by inverse document frequency, counted over all documents, and projected on
the first singular directions of the labelled documents. The labelled vectors are broadcast (their number is
bounded); each block of documents is multiplied with all of them, so cosines are exact, and the nearest vote
with their cosine as weight. Cosines are told apart to five places; neighbours that tie for the last places share them in equal parts,
so neither order nor block decides.

Every text is read whole, once: its counted terms (:func:`counted`) are what frequencies, learning and scores are taken from, and are
worth storing in between.

Learning is bounded: at most about ``MOST_LABELLED`` labelled documents, chosen by hash outside the held-out fold, half
of them of each label where there are enough; votes are weighted back to the share each label has. Of documents that share a labelled
id, one is learnt from: that with the least counted terms. NULL and empty texts, and texts unlike any labelled one, score the share of label 1. Repeated rows
score alike; without labels every score is 1. Labels with NULLs are skipped; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import WORD, held_out, map_rows, stored

MOST_LABELLED = 4_000
NEAREST = 15
DIMENSIONS = 64
WORD_TERMS = 1_024
SHAPE_TERMS = 256
TERMS = WORD_TERMS + SHAPE_TERMS + 1
REPEATS = TERMS - 1
BLOCK = 512
CACHE = 500_000
PLACES = 5
_RUNS = ((re.compile(r"[A-ZÀ-Þ]+"), "X"), (re.compile(r"[^\W\d_A-ZÀ-Þ]+"), "x"), (re.compile(r"\d+"), "9"))


def _places(word: str) -> tuple[int, int]:
    shape = word
    for pattern, sign in _RUNS:
        shape = pattern.sub(sign, shape)
    return crc32(word.encode("utf-8", "replace")) % WORD_TERMS, WORD_TERMS + crc32(shape.encode("utf-8", "replace")) % SHAPE_TERMS


class Terms:
    """Term counts of texts; remembers the words it has seen."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def count(self, text: str | None, out: np.ndarray) -> None:
        if not text:
            return
        words, known = WORD.findall(text), self.known
        places, amounts = [], []
        for word, n in Counter(words).items():
            own = known.get(word)
            if own is None:
                if len(known) >= CACHE:
                    known.clear()
                own = known[word] = _places(word)
            places += own
            amounts += (n, n)
        out += np.bincount(places, amounts, TERMS)
        out[REPEATS] += sum(map(eq, words, words[1:]))

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        counts = np.zeros((len(texts), TERMS))
        for row, text in zip(counts, texts, strict=True):
            self.count(text, row)
        return counts


def packed(row: np.ndarray) -> bytes:
    """Term counts as bytes: the places that occur (16 bits each), then their amounts (32 bits each)."""
    places = np.flatnonzero(row)
    return places.astype("<u2").tobytes() + row[places].astype("<u4").tobytes()


def unpacked(terms: list[bytes]) -> np.ndarray:
    counts = np.zeros((len(terms), TERMS))
    for row, own in zip(counts, terms, strict=True):
        n = len(own) // 6
        row[np.frombuffer(own, "<u2", n)] = np.frombuffer(own, "<u4", n, 2 * n)
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-9)


class Model:
    def __init__(self, weight: np.ndarray, axes: np.ndarray, vectors: np.ndarray, votes: np.ndarray, labels: np.ndarray, share: float):
        self.weight, self.axes, self.vectors, self.votes, self.labels, self.share = weight, axes, vectors, votes, labels, share

    def scores(self, terms: list[bytes]) -> list[float]:
        """Scores of documents given by their counted terms."""
        out: list[float] = []
        for start in range(0, len(terms), BLOCK):
            out += self._block(terms[start:start + BLOCK])
        return out

    def _block(self, terms: list[bytes]) -> list[float]:
        if not len(self.vectors):
            return [self.share] * len(terms)
        own = project(unpacked(terms), self.weight, self.axes)
        cosine = np.round(own @ self.vectors.T, PLACES)
        nearest = min(NEAREST, cosine.shape[1])
        best = np.argpartition(-cosine, nearest - 1, axis=1)[:, :nearest]
        found = np.take_along_axis(cosine, best, axis=1)
        last = found.min(axis=1, keepdims=True)
        power = np.where(found > last, np.clip(found, 0, None) * self.votes[best], 0.0)
        total, good = power.sum(axis=1), (power * self.labels[best]).sum(axis=1)
        row, tied = np.nonzero(cosine == last)
        places = nearest - (found > last).sum(axis=1)
        part = np.clip(last[:, 0], 0, None) * places / np.bincount(row, minlength=len(cosine))
        power = part[row] * self.votes[tied]
        total += np.bincount(row, power, len(cosine))
        good += np.bincount(row, power * self.labels[tied], len(cosine))
        share = np.where(total > 1e-6, good / np.maximum(total, 1e-6), self.share)
        return np.clip(share, 0, 1).round(6).astype(float).tolist()


def project(counts: np.ndarray, weight: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return _unit((_unit(np.log1p(counts) * weight) @ axes).astype(np.float32))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, terms``: the packed term counts of every whole text."""
    def run(batches) -> Iterator:
        terms = Terms()
        for keys, texts in batches:
            found = []
            for start in range(0, len(texts), BLOCK):
                found += map(packed, terms.matrix(texts[start:start + BLOCK]))
            yield keys, found

    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, terms binary")


def document_frequencies(known: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents per term, over all of ``known`` (:func:`counted`)."""
    def run(batches) -> Iterator:
        seen, total = np.zeros(TERMS, np.int64), 0
        for (terms,) in batches:
            total += len(terms)
            places = [np.frombuffer(own, "<u2", len(own) // 6) for own in terms]
            seen += np.bincount(np.concatenate([np.zeros(0, "<u2"), *places]), minlength=TERMS)
        yield [*range(TERMS), -1], [*seen.tolist(), total]

    per = map_rows(known.select("terms"), run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in per.collect()}  # one row per term
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(TERMS)])


def learn(
    known: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", most: int = MOST_LABELLED
) -> Model:
    """Fit from labelled rows outside the held-out fold; term statistics cover all of ``known`` (:func:`counted`)."""
    fold = labels.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    marked = stored(fold.groupBy("id").agg(F.max("label").alias("label")), "quality-labels")
    sizes = {int(r.label): r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(sizes.values())
    share = sizes.get(1, 0) / n if n else 1.0
    empty = Model(np.zeros(TERMS), np.zeros((TERMS, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), share)
    if not n:
        return empty
    span = 1 << 30
    quota = {label: min(1.0, most / len(sizes) / size) for label, size in sizes.items()}
    limit = F.create_map(*[F.lit(int(x)) for pair in ((k, v * span) for k, v in quota.items()) for x in pair])
    picked = stored(
        marked.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(span)) < limit[F.col("label").cast("int")]),
        "quality-picked",
    )
    total, seen = document_frequencies(known)
    weight = np.log((1 + total) / (1 + seen)) + 1.0

    own = known.select(F.col(id_col).alias("doc"), "terms").join(picked, F.col("doc") == F.col("id"))
    sample = own.groupBy("id").agg(F.min("label").cast("int").alias("label"), F.min("terms").alias("terms"))
    rows = sorted(sample.collect(), key=lambda r: r.id)  # bounded by ``most``
    if not rows:
        return empty
    x = _unit(np.log1p(unpacked([bytes(r.terms) for r in rows])) * weight)
    marks = np.array([r.label for r in rows], float)
    values, directions = np.linalg.eigh(x.T @ x)
    kept = np.argsort(-values)[:DIMENSIONS]
    axes = directions[:, kept]
    votes = np.array([1 / max(quota[int(m)], 1e-9) for m in marks])
    return Model(weight, axes, _unit((x @ axes).astype(np.float32)), votes / votes.max(), marks, share)


def score(known: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """``id, score`` for every document of ``known`` (:func:`counted`); the score of label 1 is between 0 and 1."""
    shipped = known.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator:
        for keys, terms in batches:
            yield keys, shipped.value.scores(terms)

    return map_rows(known.select(id_col, "terms"), run, f"`{id_col}` {dict(known.dtypes)[id_col]}, score double")
