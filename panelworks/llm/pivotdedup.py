"""Near-duplicate vectors by a pivot-permutation index.

Two vectors are linked if their labels are equal and their cosine is at least ``least``. The result
has the number of links of each vector and the smallest id it can reach over links.

1. Equal vectors of a label are one class with a number of rows, folded in the map tasks. From then on a class counts
   as one vector; its rows are linked with each other.
2. Pivots are chosen from a sample of at most ``SAMPLE`` classes, each as far from those before it as can be. A class is
   described by its ``nearest`` pivots in order, nearest first.
3. Inverted lists: a class stands in the lists of its first ``posted`` pivots, one list for each label. Two classes of a list
   that share at least ``shared`` pivots of their descriptions are candidates, and their cosine is computed. A pair meets in the
   first list that both share, so each is counted once.
4. A list that is long is dealt out by a second pivot where that makes less work: candidates share several pivots, so they meet there
   too. What is still long is cut into blocks, any two of which meet in a task of their own. No pair
   leaves a task: each class gives its number of links there and one link to the first of its component there.
5. Those links are contracted to components.

The candidates are an approximation: a pair near the threshold that shares too few pivots is not found. Every link that
is counted has been verified in double precision.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, are linked with nothing. Only
vectors of one length are compared. Every row is a vector of its own, also if it repeats an id; rows without an id
take no part and have no component. All rows are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.llm import store
from panelworks.llm.neardup import components

LEAST = 0.93
#: Pivots that describe a vector, those of them whose lists it stands in, and those that a pair has to share.
NEAREST = 12
POSTED = 4
SHARED = 3
#: Classes the pivots are chosen from.
SAMPLE = 4096
#: Fewest and most pivots; in between so many that a list has about ``LIST`` classes.
PIVOTS = (64, 2048)
LIST = 256
#: Classes of a list in one block, and length from which a list is dealt out.
BLOCK = 1024

KEY = ["label", "dim", "p", "q"]


def farthest(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` of the unit vectors ``points``, each the one least like those before it."""
    chosen = [0]
    nearest = points @ points[0]
    while len(chosen) < min(count, len(points)):
        chosen.append(int(nearest.argmin()))
        np.maximum(nearest, points @ points[chosen[-1]], out=nearest)
    return points[chosen]


@lru_cache(maxsize=64)
def drawn(dim: int, count: int) -> np.ndarray:
    """Pivots for a length of which the sample holds no vector."""
    points = np.random.default_rng(dim).normal(size=(count, dim))
    return points / np.linalg.norm(points, axis=1)[:, None]


def units(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors from the bytes of ``dim`` doubles each; scaled first, so that nothing overflows."""
    found = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    found = found / np.abs(found).max(axis=1)[:, None]
    return found / np.linalg.norm(found, axis=1)[:, None]


def nearest_pivots(points: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest pivots of each point, nearest first, ties to the first pivot."""
    near = points @ pivots.T
    count = min(count, near.shape[1])
    some = np.sort(np.argpartition(-near, count - 1, axis=1)[:, :count], axis=1)
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable"), axis=1)


def _digested(rows: DataFrame, with_vectors: bool) -> DataFrame:
    """(vec_id, label, digest, dim[, vector]) of every row; the digest is null if it takes no part."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            flat = lists.flatten()
            values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            apart = [c.is_null().to_numpy(zero_copy_only=False) for c in (batch.column("vec_id"), batch.column("label"))]
            raw, digests = [], []
            for k, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
                own = values[end - length : end]
                fits = length and not apart[0][k] and not apart[1][k] and np.isfinite(own).all() and own.any()
                raw.append(own.tobytes() if fits else None)
                digests.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if fits else None)
            columns = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "digest": pa.array(digests, pa.binary()), "dim": pa.array(lengths, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | ({"vector": pa.array(raw, pa.binary())} if with_vectors else {}))

    plain = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return plain.mapInArrow(made, "vec_id long, label string, digest binary, dim int" + ", vector binary" * with_vectors)


def _described(classes: DataFrame, pivots: dict[int, np.ndarray], count: int, nearest: int) -> DataFrame:
    """The classes with their pivots in order; the pivots are at most ``PIVOTS`` vectors for each sampled length."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            raw = batch.column("vector").to_pylist()
            found: list[np.ndarray | None] = [None] * len(dims)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                by = pivots[dim] if dim in pivots else drawn(int(dim), count)
                for first in range(0, len(own), 512):
                    some = own[first : first + 512]
                    for k, order in zip(some, nearest_pivots(units([raw[i] for i in some], int(dim)), by, nearest)):
                        found[k] = order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, "pivots"])

    return classes.mapInArrow(made, "node long, label string, dim int, n long, vector binary, pivots array<int>")


def _lists(described: DataFrame, posted: int, block: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The rows of the inverted lists (label, dim, p, q, node), how long each list is, and tables to drop later.

    q is -1 where the list of pivot p is taken as it is. A longer one is dealt out by a second pivot q of the
    descriptions if the work, by the squares of the lengths, is at most half of it then.
    """
    own = described.select("label", "dim", "node", "pivots", F.explode(F.slice("pivots", 1, posted)).alias("p"))
    key = ["label", "dim", "p"]
    size = F.count(F.lit(1)).alias("size")
    whole = store.written(own.groupBy(*key).agg(size).filter("size > 1"), "lists")
    second = own.join(whole.filter(F.col("size") > block).select(*key), key)
    second = second.select(*key, F.explode(F.array_remove("pivots", F.col("p"))).alias("q"), "node")
    parts = store.written(second.groupBy(*KEY).agg(size).filter("size > 1"), "second-lists")
    work = parts.groupBy(*key).agg(F.sum(F.col("size") * F.col("size")).alias("_work"))
    dealt = whole.filter(F.col("size") > block).join(work, key, "left").filter(F.coalesce("_work", F.lit(0)) * 2 <= F.col("size") * F.col("size"))
    dealt = store.written(dealt.select(*key), "dealt-lists")
    sizes = whole.join(dealt, key, "left_anti").select(*key, F.lit(-1).alias("q"), "size").union(parts.join(dealt, key, "left_semi").select(*KEY, "size"))
    rows = own.join(dealt, key, "left_anti").select(*key, F.lit(-1).alias("q"), "node").union(second.join(dealt, key, "left_semi").select(*KEY, "node"))
    return rows, store.written(sizes, "list-sizes"), [whole, parts, dealt]


def _compared(posted: int, shared: int, least: float):
    """Links of one meeting of two blocks of a list: (node, links, first)."""

    def run(table: pa.Table) -> pa.Table:
        p, q, x, y, dim = (table.column(c)[0].as_py() for c in ("p", "q", "x", "y", "dim"))
        ids, times, slot = (table.column(c).to_numpy() for c in ("node", "n", "slot"))
        by = np.stack(table.column("pivots").to_pylist())
        vectors = units(table.column("vector").to_pylist(), dim)
        names, at = np.unique(by, return_inverse=True)
        holds = np.zeros((len(ids), len(names)), np.float32)
        np.put_along_axis(holds, at.reshape(by.shape), 1, axis=1)
        left, right = np.flatnonzero(slot == x), np.flatnonzero(slot == y)
        common = holds[left] @ holds[right].T  # pivots that a pair shares
        close = (common >= min(shared, by.shape[1])) & (vectors[left] @ vectors[right].T >= least)
        i, j = np.nonzero(np.triu(close, 1) if x == y else close)
        i, j = left[i], right[j]
        keep = np.zeros(len(i), bool)
        for first in range(0, len(i), 1 << 16):
            a, b = by[i[first : first + (1 << 16)]], by[j[first : first + (1 << 16)]]
            heads = (a[:, :posted, None] == b[:, None, :posted]).any(axis=2)
            here = np.where(heads, a[:, :posted], np.iinfo(np.int32).max).min(axis=1) == p
            if q >= 0:
                both = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != p)
                here &= np.where(both, a, np.iinfo(np.int32).max).min(axis=1) == q
            keep[first : first + (1 << 16)] = here
        i, j = i[keep], j[keep]
        links = np.bincount(i, times[j], len(ids)) + np.bincount(j, times[i], len(ids))
        label = np.arange(len(ids))
        while len(i):
            low = np.minimum(label[i], label[j])
            after = label.copy()
            np.minimum.at(after, i, low)
            np.minimum.at(after, j, low)
            after = after[after]
            if (after == label).all():
                break
            label = after
        linked = np.flatnonzero(links > 0)
        return pa.table({"node": ids[linked], "links": links[linked].astype(np.int64), "first": ids[label[linked]]})

    return run


def near_vectors(
    rows: DataFrame, least: float = LEAST, nearest: int = NEAREST, posted: int = POSTED, shared: int = SHARED, block: int = BLOCK, pivots: tuple[int, int] = PIVOTS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, embedding, label)."""
    known = store.written(_digested(rows, False), "digests")
    key = ["label", "dim", "digest"]
    classes = _digested(rows, True).filter("digest IS NOT NULL").groupBy(*key)
    classes = classes.agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"))
    classes = store.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # pivots: as many as the longest label asks for, from a bounded sample
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    count = int(np.clip(1 << max(0, posted * largest // LIST).bit_length(), *pivots))
    sample = classes.select("dim", "digest", "vector").orderBy("digest", "label").limit(SAMPLE).collect()
    chosen = {}
    for dim in {r["dim"] for r in sample}:
        chosen[dim] = farthest(units([bytes(r["vector"]) for r in sample if r["dim"] == dim], dim), count)
    described = store.written(_described(classes.select("node", "label", "dim", "n", "vector"), chosen, count, nearest), "described")

    postings, sizes, spent = _lists(described, posted, block)
    slots = F.ceil(F.col("size") / block).cast("int")
    placed = postings.join(sizes, KEY).withColumn("_slots", slots).withColumn("slot", F.pmod(F.xxhash64("node"), F.col("_slots")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("_slots") - 1), lambda j: F.struct(F.least("slot", j).alias("x"), F.greatest("slot", j).alias("y")))
    placed = placed.select(*KEY, "node", "slot", F.explode(meet).alias("_meet"))
    placed = placed.join(described.select("node", "n", "vector", "pivots"), "node")
    placed = placed.select(*KEY, F.col("_meet.x").alias("x"), F.col("_meet.y").alias("y"), "node", "slot", "n", "vector", "pivots")
    found = placed.groupBy(*KEY, "x", "y").applyInArrow(_compared(posted, shared, least), "node long, links long, first long")
    found = store.written(found, "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("_links"))
    reach = components(found.select(F.col("node").alias("a"), F.col("first").alias("b")))
    named = classes.select(*key, "node", "n", "vec_id").join(links, "node", "left").join(reach, "node", "left")
    named = store.written(named.withColumn("component", F.coalesce("component", "node")), "named")
    smallest = store.written(named.groupBy("component").agg(F.min("vec_id").alias("component_id")), "smallest")
    total = F.coalesce("_links", F.lit(0)) + F.col("n") - 1
    named = store.written(named.join(smallest, "component").select(*key, total.alias("n_links"), "component_id"), "vector-components")
    store.dropped(classes, described, sizes, found, smallest, *spent)
    alone = known.filter("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = known.filter("digest IS NOT NULL").join(named, key).select("vec_id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
