"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a text are its distinct words, word pairs, and pairs with one word between, each
hashed to one of 2 ** ``bits`` coordinates. A word counts in three forms: whole, and cut to its first
four and five bytes, so that other endings of a known word are known too. Training goes through a bounded sample of labelled
texts one by one; each coordinate has its own rate, and the L1 term keeps most weights at exactly
zero. What is sent to the executors are the coordinates that are not zero.

Null and empty texts have no features and get the score of the intercept. Repeated rows get the
same score each. An empty table of labels gives the score 0.5 for every text, predicted 1 only
at or above the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.llm import text as T

BITS = 20
#: Most labelled texts one fit reads; they are the first in the order of a hash of their id.
SAMPLE_ROWS = 8_000
#: Bytes of the cut forms of a word.
STEMS = (4, 5)


def coordinates(stems: list[np.ndarray], bounds: np.ndarray, bits: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, coordinate) pairs; ``stems`` holds the hashes of each form of the words.

    The last form is the whole word, of which the pairs are made. ``wanted`` keeps the coordinates
    for which it is true.
    """
    shift = np.uint64(64 - bits)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    h = stems[-1]
    pairs = [(owner, s) for s in stems]
    for gap, salt in ((1, 3), (2, 5)):
        same = owner[:-gap] == owner[gap:]
        pairs.append((owner[:-gap][same], (h[:-gap] * np.uint64(salt) + h[gap:] + np.uint64(gap))[same]))
    keys = []
    for own, value in pairs:
        at = (T.mixed(value) >> shift).astype(np.int64)
        if wanted is not None:
            own, at = own[wanted[at]], at[wanted[at]]
        keys.append(own << bits | at)
    once = T.distinct(np.concatenate(keys))
    return once >> bits, once & ((1 << bits) - 1)


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, in ascending order of their coordinates."""

    bits: int
    at: np.ndarray
    weight: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.at] = self.weight
        return dense


def ftrl(
    rows: list[tuple[np.ndarray, int]],
    bits: int = BITS,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 1.0,
    epochs: int = 5,
) -> Model:
    """FTRL-proximal over (coordinates, label) rows, in their order, ``epochs`` times."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z0 = n0 = 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    for _ in range(epochs):
        for at, label in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            w0 = -z0 / ((beta + n0**0.5) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + w0, -35, 35)))
            g = p - label
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - rate * w
            n[at] = ni + g * g
            rate0 = ((n0 + g * g) ** 0.5 - n0**0.5) / alpha
            z0 += g - rate0 * w0
            n0 += g * g
    w = weights(z, n)
    at = np.flatnonzero(w)
    return Model(bits, at, w[at].astype(np.float32), float(-z0 / ((beta + n0**0.5) / alpha)))


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    lowered = T.LOWER[data]
    starts, ends, bounds = T.words(lowered, offsets, T.ALNUM)
    forms = [T.word_hashes(lowered, starts, np.minimum(ends, starts + cut)) + np.uint64(cut) for cut in STEMS]
    return [*forms, T.word_hashes(lowered, starts, ends)], bounds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts, the first by a hash of the id: (doc_id, text, _label).

    Of several texts of one id the one with the smallest hash counts; they are folded in the map tasks.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id")
        .limit(rows)
    )
    # ``rows`` ids and labels: a proven bound for the broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "_label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fit on at most ``sample_rows`` labelled texts; their features are made on the executors."""

    def featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                owner, at = coordinates(*_hashed(data, offsets), bits)
                cuts = np.searchsorted(owner, np.arange(hi - lo + 1))
                found = [at[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[lo:hi],
                        "label": batch.column("_label")[lo:hi],
                        "at": pa.array([x.tobytes() for x in found], pa.binary()),
                    }
                )

    sample = labelled_sample(docs, labels, label, sample_rows)
    rows = sample.mapInArrow(featurized, "doc_id long, label int, at binary").collect()
    rows.sort(key=lambda r: int(T.mixed(np.array([r["doc_id"]]).astype(np.uint64))[0]))
    return ftrl([(np.frombuffer(r["at"], np.int32), r["label"]) for r in rows], bits)


def scores(data: np.ndarray, offsets: np.ndarray, model: Model, dense: np.ndarray) -> np.ndarray:
    """Probabilities of the texts of one slice."""
    owner, at = coordinates(*_hashed(data, offsets), model.bits, dense != 0)
    total = model.bias + np.bincount(owner, dense[at], len(offsets) - 1)
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, over whole texts."""
    # at most 2 ** bits weights
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = model.table()
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                value = scores(data, offsets, model, dense)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[lo:hi],
                        "score": pa.array(value, pa.float64()),
                        "predicted": pa.array((value >= threshold).astype(np.int32), pa.int32()),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` below ``threshold``, with all their columns, in one pass and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = model.table()
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                value = scores(data, offsets, model, dense)
                yield batch.slice(lo, hi - lo).filter(pa.array(value < threshold))

    return docs.mapInArrow(kept, docs.schema)
