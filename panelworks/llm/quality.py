"""Text quality by a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes that overlap by the width of a filter, so every run of bytes
lies in a chunk and the chunks cover the whole text. Bytes have learned vectors, filters are learned
over runs of them, each chunk keeps the largest response of each filter. Means and maxima of the chunks
are combined into one probability.

Vectors and filters are learned on chunks of a bounded sample of labelled texts, by gradient steps through the
places of the largest responses; the last layer is fitted on whole texts of the same sample.
For scoring, vectors and filters are multiplied out into one table for each place of a filter.

Null and empty texts have one chunk of padding and get its score. Repeated rows get the same score each. Without
labels every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelworks.llm import text as T
from panelworks.llm.toxicity import labelled_sample

CHUNK = 512
WIDTH = 6
FILTERS = 16
VECTOR = 8
#: Most labelled texts of a fit, and most chunks of one of them that the filters learn from.
SAMPLE_ROWS = 4_000
TEXT_CHUNKS = 8
STEPS = 700
BATCH = 96
PAD = 0


@dataclass
class Network:
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # WIDTH x VECTOR x FILTERS
    bias: np.ndarray  # FILTERS
    mean: np.ndarray  # of the pooled features
    scale: np.ndarray
    last: np.ndarray  # 2 * FILTERS + 1

    def table(self) -> np.ndarray:
        return np.einsum("bv,wvf->wbf", self.vectors, self.filters).astype(np.float32)


def chunks_of(data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks, and for each text the range of its chunks; a text has one at least."""
    size = np.diff(offsets)
    step = chunk - width + 1
    many = np.maximum(1, -(-np.maximum(size - width + 1, 0) // step))
    cuts = np.concatenate([[0], np.cumsum(many)])
    inside = np.arange(cuts[-1]) - np.repeat(cuts[:-1], many)
    return np.repeat(offsets[:-1], many) + inside * step, cuts


def responses(rows: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter responses at all places of chunks (rows of bytes): chunks x places x filters."""
    places = rows.shape[1] - len(table) + 1
    out = table[0][rows[:, :places]]
    for w in range(1, len(table)):
        out += table[w][rows[:, w : w + places]]
    out += bias
    return out


def grid(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, cuts: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The bytes of each chunk; past the end of its text there is padding."""
    at = starts[:, None] + np.arange(chunk)
    end = np.repeat(offsets[1:], np.diff(cuts))
    inside = at < end[:, None]
    padded = np.append(data, np.uint8(PAD))
    return np.where(inside, padded[np.minimum(at, len(data))], np.uint8(PAD))


def pooled(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Mean and maximum over the chunks of each text of the largest responses: texts x 2 filters."""
    starts, cuts = chunks_of(data, offsets)
    best = np.empty((len(starts), len(bias)), np.float32)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(cuts))
    padded = np.append(data, np.zeros(CHUNK, np.uint8))
    windows = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)
    for first in range(0, len(starts), 64):
        some = starts[first : first + 64]
        rows = windows[some].copy()
        short = np.flatnonzero(some + CHUNK > offsets[owner[first : first + 64] + 1])
        for i in short:
            rows[i, offsets[owner[first + i] + 1] - some[i] :] = PAD
        best[first : first + 64] = responses(rows, table, bias).max(axis=1)
    np.maximum(best, 0, out=best)
    many = np.diff(cuts)[:, None]
    means = np.add.reduceat(best, cuts[:-1], axis=0) / many
    return np.concatenate([means, np.maximum.reduceat(best, cuts[:-1], axis=0)], axis=1).astype(np.float32)


def learn_filters(rows: np.ndarray, label: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 3) -> tuple[np.ndarray, ...]:
    """Byte vectors, filters and biases from labelled chunks, by Adam."""
    rng = np.random.default_rng(seed)
    p = {
        "vectors": rng.normal(0, 0.5, (256, VECTOR)),
        "filters": rng.normal(0, 0.4, (WIDTH, VECTOR, FILTERS)),
        "bias": np.zeros(FILTERS),
        "out": rng.normal(0, 0.3, FILTERS),
        "base": np.zeros(1),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    by_label = [np.flatnonzero(label == v) for v in (0, 1)]
    if not len(by_label[0]) or not len(by_label[1]):
        return p["vectors"], p["filters"], p["bias"]
    for step in range(1, steps + 1):
        # both labels half and half
        some = np.concatenate([rng.choice(own, batch // 2) for own in by_label])
        x, y = rows[some], label[some]
        table = np.einsum("bv,wvf->wbf", p["vectors"], p["filters"]).astype(np.float32)
        r = responses(x, table, p["bias"].astype(np.float32))
        place = r.argmax(axis=1)
        top = np.take_along_axis(r, place[:, None, :], axis=1)[:, 0, :]
        act = np.maximum(top, 0)
        z = act @ p["out"] + p["base"][0]
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        back = d[:, None] * p["out"][None, :] * (top > 0)
        g = {"out": act.T @ d + 1e-3 * p["out"], "base": np.array([d.sum()]), "bias": back.sum(axis=0)}
        g["vectors"], g["filters"] = 1e-5 * p["vectors"], 1e-4 * p["filters"]
        for w in range(WIDTH):
            byte = np.take_along_axis(x, place + w, axis=1).astype(np.int64)
            change = np.bincount((byte * FILTERS + np.arange(FILTERS)).ravel(), back.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            g["vectors"] = g["vectors"] + change @ p["filters"][w].T
            g["filters"][w] += p["vectors"].T @ change
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p["vectors"], p["filters"], p["bias"]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression with a constant, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Network:
    """Fit on at most ``sample_rows`` labelled texts; the executors cut the chunks and pool the texts."""
    sample = labelled_sample(docs, labels, label, sample_rows)

    def some_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                starts, cuts = chunks_of(data, offsets)
                rows = grid(data, offsets, starts, cuts)
                chosen = []
                for a, b in zip(cuts, cuts[1:]):
                    # evenly over the whole text
                    chosen.append(np.unique(np.linspace(a, b - 1, min(b - a, TEXT_CHUNKS)).astype(np.int64)))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id")[lo:hi], "label": batch.column("_label")[lo:hi], "chunks": [rows[c].tobytes() for c in chosen]}
                )

    found = sample.mapInArrow(some_chunks, "doc_id long, label int, chunks binary").collect()
    found.sort(key=lambda r: r["doc_id"])
    if found:
        parts = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in found]
        label_of = np.repeat([r["label"] for r in found], [len(c) for c in parts])
        vectors, filters, bias = learn_filters(np.concatenate(parts), label_of)
    else:
        vectors, filters, bias = np.zeros((256, VECTOR)), np.zeros((WIDTH, VECTOR, FILTERS)), np.zeros(FILTERS)
    network = Network(vectors, filters, bias, np.zeros(2 * FILTERS), np.ones(2 * FILTERS), np.zeros(2 * FILTERS + 1))
    if not found:
        return network
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        table, bias = network.table(), network.bias.astype(np.float32)
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                x = pooled(data, offsets, table, bias)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id")[lo:hi], "label": batch.column("_label")[lo:hi], "x": [r.tobytes() for r in x]}
                )

    rows = sample.mapInArrow(whole, "doc_id long, label int, x binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float)
    y = np.array([r["label"] for r in rows], float)
    network.mean, network.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    if 0 < y.mean() < 1:
        network.last = logistic((x - network.mean) / network.scale, y)
    return network


def score(docs: DataFrame, network: Network, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, over whole texts."""
    # tables of a fixed size
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        table, bias = network.table(), network.bias.astype(np.float32)
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                x = (pooled(data, offsets, table, bias) - network.mean) / network.scale
                value = 1 / (1 + np.exp(-np.clip(x @ network.last[:-1] + network.last[-1], -30, 30)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[lo:hi],
                        "score": pa.array(value, pa.float64()),
                        "predicted": pa.array((value >= threshold).astype(np.int32), pa.int32()),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double, predicted int")
