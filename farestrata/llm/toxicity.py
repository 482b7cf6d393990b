"""Toxicity by non-negative learning from positive and unlabelled documents.

Learning sees confirmed toxic documents and unlabelled ones; labels that say "not toxic" serve only to estimate the
share of toxic documents. A linear classifier over word presence is trained in numpy with the
non-negative risk ``p * R+(toxic) + max(0, R-(unlabelled) - p * R-(toxic))``: where the second part falls below
zero, the step goes back on it instead of fitting the toxic documents hidden among the unlabelled as clean. Several classifiers with
different seeds are averaged.

Features are the words of a text, lower-cased, and their beginnings of 4 and 5 letters, each once per document, so that a long text
doesn't dilute what it says and inflected forms count together; words have three letters or more. Features are counted over the
toxic documents and over all unlabelled ones. Those whose shares in both sets differ by ``APART`` standard deviations are kept, the ``FEATURES``
that differ most if there are more.

What the classifiers are fitted on is bounded: at most about ``MOST_TOXIC`` toxic and ``MOST_OPEN`` unlabelled documents, chosen by hash, from the rows
outside the held-out fold. Scoring reads every document whole. NULL and empty texts are scored by the bias alone. Repeated rows
score alike; without any toxic label every score is 0. Labels with NULLs are skipped; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import held_out, keep_batches_small, map_rows, ship, stored

MOST_TOXIC = 4_000
MOST_OPEN = 12_000
FEATURES = 400
#: Standard deviations by which a feature must differ between the two sets, so that few labels don't bring in chance.
APART = 4.0
PREFIXES = (4, 5)
SEEDS = (1, 2, 3)
STEPS = 600
BATCH, OPEN_BATCH = 512, 2_048
RATE = 0.05
DECAY = 1e-4
LETTERS = re.compile(r"[^\W\d_]{3,}")
CACHE = 500_000


def _parts(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def features_of(text: str | None, known: dict[str, tuple[str, ...]] | None = None) -> set[str]:
    """``known``: features of words seen before; grows to ``CACHE`` words."""
    known, found = {} if known is None else known, set()
    for word in set(LETTERS.findall((text or "").lower())):
        own = known.get(word)
        if own is None:
            if len(known) >= CACHE:
                known.clear()
            own = known[word] = tuple(_parts(word))
        found.update(own)
    return found


class Model:
    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray):
        self.at = {name: i for i, name in enumerate(names)}
        self.weights, self.bias = weights, bias
        self.known: dict[str, tuple[int, ...]] = {}

    def positions(self, text: str | None) -> set[int]:
        at, known, found = self.at, self.known, set()
        for word in set(LETTERS.findall((text or "").lower())):
            own = known.get(word)
            if own is None:
                own = tuple(at[p] for p in _parts(word) if p in at)
                if len(known) >= CACHE:
                    known.clear()
                known[word] = own
            if own:
                found.update(own)
        return found

    def score(self, text: str | None) -> float:
        """Mean probability of the classifiers; rows of ``weights`` are features, columns classifiers."""
        if not len(self.bias):
            return 0.0
        total = self.bias + self.weights[sorted(self.positions(text))].sum(axis=0)
        return round(float((1 / (1 + np.exp(-np.clip(total, -50, 50)))).mean()), 6)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}


def train_one(
    toxic: np.ndarray, open_: np.ndarray, prior: float, seed: int, steps: int = STEPS
) -> tuple[np.ndarray, float]:
    """Weights and bias from two 0/1 matrices by Adam on the non-negative risk with the (bounded) sigmoid loss."""
    rng = np.random.default_rng(seed)
    width = toxic.shape[1]
    theta = np.zeros(width + 1)
    theta[-1] = -1
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def part(rows: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean loss for ``sign`` and its gradient."""
        margin = np.clip(sign * (rows @ theta[:-1] + theta[-1]), -50, 50)
        loss = 1 / (1 + np.exp(margin))
        slope = -sign * loss * (1 - loss) / len(rows)
        return float(loss.mean()), np.append(slope @ rows, slope.sum())

    for step in range(1, steps + 1):
        p = toxic[rng.integers(0, len(toxic), min(BATCH, len(toxic)))]
        u = open_[rng.integers(0, len(open_), min(OPEN_BATCH, len(open_)))]
        _, toxic_right = part(p, 1.0)
        toxic_wrong_loss, toxic_wrong = part(p, -1.0)
        open_loss, open_right = part(u, -1.0)
        negative = open_loss - prior * toxic_wrong_loss
        step_by = prior * toxic_right + open_right - prior * toxic_wrong if negative >= 0 else prior * toxic_wrong - open_right
        step_by[:-1] += DECAY * theta[:-1]
        first = 0.9 * first + 0.1 * step_by
        second = 0.999 * second + 0.001 * step_by**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def learn(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    prior: float | None = None, most_toxic: int = MOST_TOXIC, most_open: int = MOST_OPEN,
) -> Model:
    """Train from the rows outside the held-out fold; ``prior`` is estimated from the labels if it isn't given."""
    fold = labels.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    marked = fold.groupBy("id").agg(F.max("label").alias("label"))
    n, toxic = marked.agg(F.count("*"), F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0))).first()
    if not toxic:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    prior = prior or min(max(toxic / n, 1e-3), 0.5)
    span = 1 << 30

    def chosen(key: str, seed: int, most: int, of: int):
        return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(span)) < int(min(1.0, most / max(of, 1)) * span)

    confirmed = stored(
        marked.where((F.col("label") == 1) & chosen("id", 5, most_toxic, toxic)).select("id"), "toxic-confirmed")
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    all_open = texts.where(~held_out("doc"))
    every_open = all_open.count()
    picked = all_open.where(chosen("doc", 9, most_open, every_open)).select(F.lit(0).alias("confirmed"), "text")
    shown = texts.join(confirmed, F.col("doc") == F.col("id"), "left_semi").select(F.lit(1).alias("confirmed"), "text")
    sample = stored(shown.union(picked), "toxic-sample")
    n_toxic, n_open = sample.agg(F.coalesce(F.sum("confirmed"), F.lit(0)), F.coalesce(F.sum(1 - F.col("confirmed")), F.lit(0))).first()
    if not n_toxic or not n_open:
        return Model([], np.zeros((0, 0)), np.zeros(0))

    def counted(batches) -> Iterator:
        parts: dict[str, tuple[str, ...]] = {}
        for marks, texts in batches:
            sides = Counter(), Counter()
            for mark, text in zip(marks, texts, strict=True):
                sides[mark].update(features_of(text, parts))
            names = list(sides[0] | sides[1])
            yield names, [sides[0][f] for f in names], [sides[1][f] for f in names]

    # the toxic documents of the sample and all unlabelled ones; counts are summed in each task before they are shuffled
    counts = (
        map_rows(sample.where("confirmed = 1").union(all_open.select(F.lit(0), "text")), counted, "name string, open bigint, toxic bigint")
        .groupBy("name").agg(F.sum("open").alias("open"), F.sum("toxic").alias("toxic"))
    )
    # the arc sine of the square root of a share has the same variance whatever the share
    gap = 2 * F.abs(F.asin(F.sqrt(F.col("toxic") / n_toxic)) - F.asin(F.sqrt(F.col("open") / every_open)))
    apart = counts.withColumn("gap", gap / (1 / n_toxic + 1 / every_open) ** 0.5).where(F.col("gap") >= APART)
    names = [r.name for r in apart.orderBy(F.desc("gap"), "name").limit(FEATURES).collect()]
    if not names:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    reader = Model(names, np.zeros((len(names), 1)), np.zeros(1))

    def placed(batches) -> Iterator:
        for marks, texts in batches:
            yield marks, [np.array(sorted(reader.positions(t)), "<i4").tobytes() for t in texts]

    matrices = {0: [], 1: []}
    # bounded: the sample has a fixed number of documents of at most FEATURES positions
    for mark, places in sorted(tuple(r) for r in map_rows(sample, placed, "confirmed int, places binary").collect()):
        row = np.zeros(len(names), np.float32)
        row[np.frombuffer(bytes(places), "<i4")] = 1
        matrices[mark].append(row)
    toxic_rows, open_rows = np.array(matrices[1]), np.array(matrices[0])
    trained = [train_one(toxic_rows, open_rows, prior, seed) for seed in SEEDS]
    return Model(names, np.stack([w for w, _ in trained], axis=1), np.array([b for _, b in trained]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every document; the score of toxicity is between 0 and 1."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator:
        for keys, texts in batches:
            yield keys, [shipped.value.score(text) for text in texts]

    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more; one pass, no shuffle, all columns as they are."""
    ship(docs.sparkSession)
    keep_batches_small(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([shipped.value.score(text) < threshold for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
