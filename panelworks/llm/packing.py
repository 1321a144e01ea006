"""Packing of tokenized texts into sequences of at most ``capacity`` tokens.

Only the histogram of piece lengths (at most ``capacity`` numbers) comes to the driver. There, all
patterns of up to three lengths that fill a sequence exactly are enumerated, non-negative least
squares fits their repeat counts to the histogram, the counts are rounded down, and what is left is
packed by best fit, longest first. The plan is a list of (pattern, count), and pieces of equal length are
interchangeable: on the executors the n-th piece of a length takes the n-th place for this length.
No piece has to know another one.

A null text is an empty one and has the end id only. Rows that repeat an id are packed each for
themselves. An empty table gives no piece. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import encode, store
from panelworks.llm import text as T

CAPACITY = 1024
END = 2
#: Rounds of the active-set fit, and patterns that one round may add.
ROUNDS = 30
ADDED = 160
#: Times a round may let patterns out again.
DROPS = 5


# ---- the plan --------------------------------------------------------------------------------


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three lengths (0: none), descending, that add up to ``capacity``."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    rows = []
    if there[capacity]:
        rows.append(np.array([[capacity, 0, 0]]))
    a = lengths[(lengths >= capacity - lengths) & (lengths < capacity)]
    a = a[there[capacity - a]]
    rows.append(np.stack([a, capacity - a, np.zeros_like(a)], axis=1))
    for c in lengths[lengths * 3 <= capacity]:
        b = lengths[(lengths >= c) & (lengths * 2 <= capacity - c)]
        b = b[there[capacity - c - b]]
        rows.append(np.stack([capacity - c - b, b, np.full_like(b, c)], axis=1))
    return np.concatenate(rows).astype(np.int64)


def nonnegative_fit(patterns: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares counts >= 0 of patterns for the histogram: (pattern numbers, counts).

    Active-set method in blocks: each round lets in the patterns of steepest descent that share no
    length, solves for the set, and lets out those whose count would be negative.
    """
    target = target.astype(float)
    target[0] = 0
    active = np.zeros(0, np.int64)
    x = np.zeros(0)
    scale = max(1.0, target.max(initial=0))
    for _ in range(ROUNDS):
        rest = target.copy()
        np.subtract.at(rest, patterns[active].ravel(), np.repeat(x, 3))
        rest[0] = 0
        slope = rest[patterns].sum(axis=1) / np.sqrt((patterns > 0).sum(axis=1))
        slope[active] = 0
        steep = np.argsort(-slope, kind="stable")[: ADDED * 20]
        steep = steep[slope[steep] > 1e-3 * scale**0.5]
        used, chosen = np.zeros(len(target), bool), []
        for p in steep:
            own = patterns[p][patterns[p] > 0]
            if not used[own].any():
                used[own] = True
                chosen.append(p)
                if len(chosen) == ADDED:
                    break
        if not chosen:
            break
        active, x = np.concatenate([active, chosen]), np.concatenate([x, np.zeros(len(chosen))])
        for _ in range(DROPS):
            matrix = np.bincount(
                patterns[active].ravel() * len(active) + np.repeat(np.arange(len(active)), 3),
                minlength=len(target) * len(active),
            ).reshape(len(target), -1).astype(float)
            matrix[0] = 0
            square = matrix.T @ matrix
            square[np.diag_indices(len(active))] += 1e-6
            x = np.linalg.solve(square, matrix.T @ target)
            stay = x > 0
            active, x = active[stay], x[stay]
            if stay.all() or not len(active):
                break
    return active, x


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over counts of lengths: (pattern, how often)."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # room left -> sequences
    full = []
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for room in sorted(r for r in open_ if r >= length):
            # as many of this length as fit, sequence by sequence
            fit = room // length
            groups = open_.pop(room)
            while groups and left:
                pattern, many = groups.pop()
                whole = min(many, left // fit)
                parts = [(fit, whole)]
                if whole < many and left - whole * fit:
                    parts.append((left - whole * fit, 1))
                for copies, times in parts:
                    if times and copies:
                        left -= copies * times
                        after = room - copies * length
                        (open_.setdefault(after, []) if after else full).append((pattern + (length,) * copies, times))
                        many -= times
                if many:
                    groups.append((pattern, many))
            if groups:
                open_.setdefault(room, []).extend(groups)
            if not left:
                break
        fit = capacity // length
        for copies, times in ((fit, left // fit), (left % fit, 1)):
            if copies and times:
                after = capacity - copies * length
                (open_.setdefault(after, []) if after else full).append(((length,) * copies, times))
    return full + [g for groups in open_.values() for g in groups]


@dataclass(frozen=True)
class Plan:
    """Places of all lengths, ascending by (length, rank of the first piece they take)."""

    key: np.ndarray  # length << 44 | first rank
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        want = (length << 44) | rank
        at = np.searchsorted(self.key, want, "right") - 1
        return self.sequence[at] + want - self.key[at], self.offset[at]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """``histogram[n]`` pieces of n tokens; the better of a few shares of the fitted counts is kept."""
    lengths = np.flatnonzero(histogram)
    lengths = lengths[lengths > 0]
    best: list[tuple[tuple[int, ...], int]] = []
    if len(lengths):
        patterns = exact_patterns(lengths, capacity)
        active, x = nonnegative_fit(patterns, histogram.copy())
        many = None
        for share in (1.0, 0.9, 0.7, 0.4, 0.2):
            left = histogram.copy()
            tried = []
            for p in active[np.argsort(-x, kind="stable")]:
                own, times = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
                count = int(min(np.floor(x[active == p][0] * share + 1e-6), (left[own] // times).min()))
                if count > 0:
                    left[own] -= count * times
                    tried.append((tuple(int(v) for v in patterns[p] if v), count))
            tried += best_fit(left, capacity)
            total = sum(c for _, c in tried)
            if many is None or total < many:
                best, many = tried, total
    rows, taken, base = [], np.zeros(capacity + 1, np.int64), 0
    for pattern, count in best:
        offset = 0
        for length in pattern:
            rows.append((int(length) << 44 | int(taken[length]), base, offset))
            taken[length] += count
            offset += length
        base += count
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 3).T
    return Plan(columns[0].copy(), columns[1].copy(), columns[2].copy(), base)


# ---- Spark -------------------------------------------------------------------------------------


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, _part, _rank) of each piece of each row.

    ``_rank`` numbers the pieces of a length within the task ``_part``. ``ids`` is null unless asked for.
    """
    # the content of a vocabulary file, a few megabytes
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        part = TaskContext.get().partitionId()
        next_rank = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, hi, ids, offsets in encode.encoded_slices(batch.column("text"), shared.value):
                ids, offsets = encode.with_end(ids, offsets, end)
                total = np.diff(offsets)
                many = -(-total // capacity)
                row = np.repeat(np.arange(hi - lo), many)
                number = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                # the first piece may be shorter, the others are full
                first = (total - capacity * (many - 1))[row]
                length = np.where(number == 0, first, capacity)
                start = np.where(number == 0, 0, first + (number - 1) * capacity)
                raw = memoryview(ids).cast("B")
                at = (offsets[row] + start) * 4
                crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(at.tolist(), (length * 4).tolist())]
                by = np.argsort(length, kind="stable")
                own = length[by]
                run = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                inside = np.arange(len(own)) - np.repeat(run, np.diff(np.append(run, len(own))))
                rank = np.empty(len(own), np.int64)
                rank[by] = inside + next_rank[own]
                next_rank += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row + lo)),
                        "piece": pa.array(number, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "ids": pa.array([bytes(raw[a : a + n]) for a, n in zip(at.tolist(), (length * 4).tolist())] if with_ids else [None] * len(row), pa.binary()),
                        "_part": pa.array(np.full(len(row), part), pa.int32()),
                        "_rank": pa.array(rank, pa.int64()),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, _part int, _rank long"
    )


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece."""
    cut = store.written(pieces(docs, tokenizer, capacity, end, with_ids), "pieces")
    counts = store.written(cut.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    # at most ``capacity`` rows
    for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    made = plan(histogram, capacity)
    # pieces of a length in earlier tasks: one row for each task and length
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    earlier = store.written(earlier, "earlier")
    # the plan has at most a few places for each length, whatever the size of the corpus
    shared = docs.sparkSession.sparkContext.broadcast(made)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        plan = shared.value
        for batch in batches:
            rank = batch.column("_rank").to_numpy() + batch.column("_before").to_numpy()
            sequence, offset = plan.place(batch.column("length").to_numpy(), rank)
            columns = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            columns |= {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": batch.column("ids")} if with_ids else {}))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "_rank", "_before"]
    joined = cut.join(earlier, ["_part", "length"]).select(*kept)
    return joined.mapInArrow(placed, schema + (", ids binary" if with_ids else ""))


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences; ids are little-endian, four bytes each.

    A sequence has at most ``capacity`` pieces, so what a group brings together is bounded.
    """
    rows = packed(docs, tokenizer, capacity, end, with_ids=True)
    grouped = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_all"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate(F.col("_all"), F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return grouped.select("sequence_id", "n_tokens", joined.alias("ids"))
