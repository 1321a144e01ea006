"""Approximate nearest neighbours by a forest of random-projection trees.

Each inner node of a tree cuts space by the direction between two centres of a few random vectors of a
sample. Every distinct vector is indexed: it lies in one leaf of each tree. A query goes
through all trees at once with one priority queue, ordered by the smallest distance to a cut on the
way; leaves come out of it until they hold ``candidates`` vectors. Those are ranked by their exact
inner products in double precision. Unless it is given, ``candidates`` is measured on the whole index: for ``TRIALS``
of the queries the true neighbours are looked for among all distinct vectors, and so it is known how many candidates it
takes to meet them; as many as give the recall ``TARGET`` are taken.

Largest inner products become smallest distances by one more coordinate, the root of what a vector lacks to the
longest one; for queries it is zero. So the trees need no vectors of equal length.

Equal vectors are one entry of the index, with its smallest ids. There are no more than ``k`` + 1 of them that
could be in a result, so a vector that a third of all rows share costs no more than another.

The trees are fitted on at most ``SAMPLE_ROWS`` distinct vectors and have at most ``2 ** MOST_DEPTH`` leaves each, the
bounds of what is collected and broadcast. Up to ``2 ** MOST_DEPTH`` times ``LEAF`` distinct vectors a leaf
holds about ``LEAF`` of them; beyond, leaves grow, and ``candidates`` with them.

Rows without an id, and vectors that are null, zero, of another than the most frequent dimension, or hold null or
non-finite components take no part. Rows that repeat an id and a vector count once; rows that repeat an id with
another vector are queries and candidates of their own, except to each other. Fewer candidates
than ``k`` give shorter results; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import store

K = 20
TREES = 16
LEAF = 128
TARGET = 0.95
TRIALS = 96
#: Vectors that one split looks at.
SPLIT_POINTS = 256
SAMPLE_ROWS = 65_536
MOST_DEPTH = 12
#: Rows of results that a task puts together.
HELD = 1 << 20


def longer(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that makes all of them as long as the longest."""
    lack = np.sqrt(np.maximum(longest**2 - (vectors.astype(float) ** 2).sum(axis=1), 0))
    return np.concatenate([vectors, lack[:, None]], axis=1).astype(np.float32)


def split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Direction between two centres of some of the points, and where to cut.

    The cut lies half-way between the centres, with at least a tenth of the points on either side.
    """
    if len(points) < 2:
        direction = rng.normal(size=points.shape[1])
        return direction / np.linalg.norm(direction), 0.0
    some = points[rng.choice(len(points), min(len(points), SPLIT_POINTS), replace=False)].astype(float)
    centres = some[:2]
    for _ in range(5):
        right = ((some - centres[0]) ** 2).sum(axis=1) > ((some - centres[1]) ** 2).sum(axis=1)
        if right.all() or not right.any():
            break
        centres = np.stack([some[~right].mean(axis=0), some[right].mean(axis=0)])
    direction = centres[1] - centres[0]
    direction /= np.linalg.norm(direction) or 1.0
    low, high = np.quantile(points @ direction, [0.1, 0.9])
    return direction, float(np.clip(centres.mean(axis=0) @ direction, low, high))


def grow(points: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and cuts of one tree, in the order of a heap."""
    rng = np.random.default_rng(seed)
    direction = np.zeros((2**depth - 1, points.shape[1]), np.float32)
    median = np.zeros(2**depth - 1, np.float32)
    node = np.zeros(len(points), np.int64)
    for level in range(depth):
        first = 2**level - 1
        by = np.argsort(node, kind="stable")
        cut = np.searchsorted(node[by], np.arange(first, 2 * first + 2))
        for n in range(first, 2 * first + 1):
            direction[n], median[n] = split(points[by[cut[n - first] : cut[n - first + 1]]], rng)
        node = 2 * node + 1 + ((points * direction[node]).sum(axis=1) > median[node])
    return direction, median


@dataclass(frozen=True)
class Forest:
    depth: int
    longest: float
    direction: np.ndarray  # trees x nodes x coordinates
    median: np.ndarray  # trees x nodes

    @property
    def trees(self) -> int:
        return len(self.median)

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point in each tree: points x trees."""
        out = np.empty((len(points), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                side = (points * self.direction[t][node]).sum(axis=1) > self.median[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, point: np.ndarray, sizes: np.ndarray, candidates: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one queue over all trees, until they hold ``candidates`` vectors."""
        inner = 2**self.depth - 1
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < candidates:
            near, t, node = heapq.heappop(queue)
            # down the nearer side; the other side waits in the queue
            while node < inner:
                margin = float(self.direction[t, node] @ point) - float(self.median[t, node])
                right = margin > 0
                far = max(near, abs(margin))
                heapq.heappush(queue, (far, t, 2 * node + 1 + (not right)))
                node = 2 * node + 1 + right
            leaf = node - inner
            if sizes[t, leaf]:
                found.append((t, leaf))
                held += int(sizes[t, leaf])
        return found


def measured_candidates(forest: Forest, sizes: np.ndarray, asked: np.ndarray, near: list[np.ndarray], least: int, target: float = TARGET) -> int:
    """Candidates, over all trees, that bring ``target`` of the neighbours whose leaves (neighbours x trees) are ``near``.

    ``sizes`` counts all indexed vectors of each leaf, so the number holds for the index that is searched.
    """
    needed = []
    for point, leaves in zip(asked, near):
        order = forest.search(point, sizes, int(sizes.sum()))
        held = np.cumsum([sizes[t, leaf] for t, leaf in order])
        place = np.full(sizes.shape, held[-1])
        for (t, leaf), total in zip(order, held):
            place[t, leaf] = total
        # when the first tree brings the neighbour
        needed += place[np.arange(forest.trees)[None, :], leaves].min(axis=1).tolist()
    return int(np.quantile(needed, target, method="higher")) if needed else least


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part, whatever their dimension."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select("vec_id", "embedding").filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    return rows.filter(~F.coalesce(bad, F.lit(True))).filter(F.coalesce(some, F.lit(False)))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dimension)


def _fit(classes: DataFrame, dimension: int, trees: int, leaf: int, sample_rows: int) -> Forest:
    spark = classes.sparkSession
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    known = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest")).first()
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(sample_rows).select("embedding").toArrow()
    points = longer(_matrix(sample.column(0).combine_chunks(), dimension), known["longest"])
    depth = int(max(0, min(np.ceil(np.log2(max(1, known["n"] / leaf))), np.log2(max(1, len(points) / 4)), MOST_DEPTH)))
    shared = spark.sparkContext.broadcast(points)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column("id").to_pylist():
                direction, median = grow(shared.value, depth, tree)
                yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int64()), "direction": [direction.tobytes()], "median": [median.tobytes()]})

    rows = spark.range(trees).repartition(trees).mapInArrow(grown, "tree long, direction binary, median binary").collect()
    rows = sorted(rows, key=lambda r: r["tree"])
    shared.unpersist()
    return Forest(
        depth,
        known["longest"],
        np.stack([np.frombuffer(r["direction"], np.float32).reshape(-1, dimension + 1) for r in rows]),
        np.stack([np.frombuffer(r["median"], np.float32) for r in rows]),
    )


def _true_neighbours(classes: DataFrame, asked: np.ndarray, own: np.ndarray, dimension: int, k: int) -> np.ndarray:
    """The classes (asked x k, -1 where there are fewer) nearest to each vector of ``asked``, by comparison with all.

    ``own`` names the classes of ``asked``, which are no neighbours of themselves. A task gives one row.
    """
    shared = classes.sparkSession.sparkContext.broadcast((asked.astype(np.float64), own))

    def merged(score: np.ndarray, names: np.ndarray, more: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score, names = np.concatenate([score, more], axis=1), np.concatenate([names, others], axis=1)
        first = np.lexsort((names, -score), axis=1)[:, :k]
        return np.take_along_axis(score, first, axis=1), np.take_along_axis(names, first, axis=1)

    def none() -> tuple[np.ndarray, np.ndarray]:
        return np.full((len(own), k), -np.inf), np.full((len(own), k), -1)

    def row(score: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"score": pa.array([score.tobytes()], pa.binary()), "names": pa.array([names.tobytes()], pa.binary())})

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, themselves = shared.value
        score, names = none()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("class").to_numpy()
            product = np.einsum("qd,md->qm", queries, _matrix(batch.column("embedding"), dimension).astype(np.float64))
            product[themselves[:, None] == ids[None, :]] = -np.inf
            some = (product >= score[:, -1:]).any(axis=0)
            product = product[:, some]
            others = np.where(np.isneginf(product), -1, ids[None, some])
            score, names = merged(score, names, product, others)
        if (names != -1).any():
            yield row(score, names)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, names = none()
        for batch in batches:
            for r in batch.to_pylist():
                score, names = merged(score, names, np.frombuffer(r["score"]).reshape(-1, k), np.frombuffer(r["names"], np.int64).reshape(-1, k))
        yield row(score, names)

    schema = "score binary, names binary"
    best = classes.select("class", "embedding").mapInArrow(compared, schema).repartition(1).mapInArrow(together, schema).first()
    shared.unpersist()
    return np.frombuffer(best["names"], np.int64).reshape(-1, k) if best else none()[1]


def _budget(forest: Forest, sizes: np.ndarray, classes: DataFrame, asking: DataFrame, dimension: int, k: int, trials: int = TRIALS) -> int:
    """``measured_candidates`` of at most ``trials`` queries, against all classes."""
    # another order than that of the vectors the trees are fitted on
    few = asking.orderBy(F.xxhash64("class", F.lit(1)), "class").limit(trials).select("class", "embedding").toArrow()
    if not few.num_rows:
        return k
    own = few.column("class").to_numpy()
    asked = _matrix(few.column("embedding").combine_chunks(), dimension)
    true = _true_neighbours(classes, asked, own, dimension, k)
    # at most trials x k vectors
    names = classes.sparkSession.createDataFrame([(i,) for i in np.unique(true[true != -1]).tolist()], "class long")
    met = classes.select("class", "embedding").join(F.broadcast(names), "class").toArrow()
    if not met.num_rows:
        return k
    leaves = forest.leaves(longer(_matrix(met.column("embedding").combine_chunks(), dimension), forest.longest))
    by_name = dict(zip(met.column("class").to_pylist(), leaves))
    near = [np.array([by_name[i] for i in row if i != -1], np.int64).reshape(-1, forest.trees) for row in true.tolist()]
    return measured_candidates(forest, sizes, np.append(asked.astype(np.float32), np.zeros((len(asked), 1), np.float32), axis=1), near, k)


def _dealt(classes: DataFrame, shared, dimension: int) -> DataFrame:
    """(cell, class, least, embedding): each class, with its smallest id, in its leaf of every tree."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = forest.leaves(longer(_matrix(batch.column("embedding"), dimension), forest.longest))
            cells = leaves + (np.arange(forest.trees) << MOST_DEPTH)
            for t in range(forest.trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[:, t]), batch.column("class"), batch.column("least"), batch.column("embedding")],
                    names=["cell", "class", "least", "embedding"],
                )

    kind = classes.schema["embedding"].dataType.simpleString()
    least = F.col("ids")[0].cast("long").alias("least")
    return classes.select("class", least, "embedding").mapInArrow(placed, f"cell long, class long, least long, embedding {kind}")


def _probed(queries: DataFrame, shared, sizes, dimension: int, candidates: int) -> DataFrame:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held = shared.value, sizes.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("embedding"), dimension).astype(np.float32)
            points = np.concatenate([points, np.zeros((len(points), 1), np.float32)], axis=1)
            for row, point in enumerate(points):
                found = forest.search(point, held, candidates)
                at = pa.array(np.full(len(found), row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t << MOST_DEPTH | leaf for t, leaf in found], pa.int64()),
                        batch.column("class").take(at),
                        batch.column("embedding").take(at),
                    ],
                    names=["cell", "class", "embedding"],
                )

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("class", "embedding").mapInArrow(searched, f"cell long, class long, embedding {kind}")


def _ranked(members: DataFrame, probes: DataFrame, dimension: int, keep: int) -> DataFrame:
    """(query, class, score): the best ``keep`` members that a task finds for each query.

    A cell arrives with its members first; of the queries, one batch at a time is in memory. What several cells
    of a task give a query is put together before it leaves the task, or when it is more than ``HELD`` rows.
    """
    asks = probes.withColumns({"least": F.lit(0).cast("long"), "_asks": F.lit(True)})
    both = members.withColumn("_asks", F.lit(False)).unionByName(asks)
    dealt = both.repartition("cell").sortWithinPartitions("cell", "_asks", "least", "class")

    def best(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        query, near, least, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((near, least, -score, query))
        query, near, least, score = query[order], near[order], least[order], score[order]
        # several trees bring the same member, with the same score
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (near[1:] != near[:-1])
        query, near, least, score = query[new], near[new], least[new], score[new]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        return query[place < keep], near[place < keep], least[place < keep], score[place < keep]

    def rows(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        query, near, _, score = found
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (query, near, score)], names=["query", "class", "score"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, names, least, vectors = None, [], [], []
        found: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("cell").to_numpy()
            asks = batch.column("_asks").to_numpy(zero_copy_only=False)
            ids = batch.column("class").to_numpy()
            smallest = batch.column("least").to_numpy()
            matrix = _matrix(batch.column("embedding"), dimension).astype(np.float64)
            cuts = np.concatenate([[0], np.flatnonzero((own[1:] != own[:-1]) | (asks[1:] != asks[:-1])) + 1, [len(own)]])
            for a, b in zip(cuts, cuts[1:]):
                if own[a] != cell:
                    cell, names, least, vectors = own[a], [], [], []
                if not asks[a]:
                    names.append(ids[a:b])
                    least.append(smallest[a:b])
                    vectors.append(matrix[a:b])
                    continue
                if not names:
                    continue
                if len(names) > 1:
                    names, least, vectors = ([np.concatenate(c)] for c in (names, least, vectors))
                block = max(1, (1 << 22) // max(1, vectors[0].size))
                for first in range(a, b, block):
                    last = min(b, first + block)
                    product = np.einsum("qd,md->qm", matrix[first:last], vectors[0])
                    many = min(keep, product.shape[1])
                    # ties go to the smaller id: members are in their order
                    top = np.argsort(-product, axis=1, kind="stable")[:, :many]
                    found.append(
                        (np.repeat(ids[first:last], many), names[0][top].ravel(), least[0][top].ravel(), np.take_along_axis(product, top, axis=1).ravel())
                    )
                    held += top.size
                    if held > HELD:
                        found = [best(found)]
                        held = len(found[0][0])
                        if held > HELD // 2:
                            yield rows(found[0])
                            found, held = [], 0
        if found:
            yield rows(best(found))

    return dealt.mapInArrow(scored, "query long, class long, score double")


def nearest(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = K,
    trees: int = TREES,
    leaf: int = LEAF,
    candidates: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``embeddings`` found for each row of
    ``queries``, both (vec_id, embedding); a row is not its own neighbour."""
    spark = embeddings.sparkSession
    valid = usable(embeddings)
    # one row for each dimension in use
    sizes = valid.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dimension = sizes["n"]
    valid = valid.filter(F.size("embedding") == dimension)
    place = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    classes = (
        valid.withColumn("_place", place)
        .filter(F.col("_place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("class"), "ids", "embedding")
    )
    # a row that repeats the smallest id of a class with another vector makes a class of its own
    classes = store.written(classes.withColumn("class", F.struct("class", F.xxhash64("embedding"))).select(F.xxhash64("class").alias("class"), "ids", "embedding"), "vector-classes")
    asked = usable(queries).filter(F.size("embedding") == dimension).distinct()
    asked = store.written(asked.join(classes.select("class", "embedding"), "embedding").select("vec_id", "class"), "queries")

    forest = _fit(classes, dimension, trees, leaf, sample_rows)
    shared = spark.sparkContext.broadcast(forest)
    members = store.written(_dealt(classes, shared, dimension), "cells")
    held = np.zeros((forest.trees, 2**forest.depth), np.int64)
    # at most trees x leaves numbers
    for r in members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["cell"] >> MOST_DEPTH, r["cell"] & ((1 << MOST_DEPTH) - 1)] = r["n"]
    asking = classes.join(asked.select("class").distinct(), "class", "left_semi")
    if candidates is None:
        candidates = _budget(forest, held, classes, asking, dimension, k)
    probes = _probed(asking, shared, spark.sparkContext.broadcast(held), dimension, candidates)
    found = _ranked(members, probes, dimension, k + 1)
    # a class that several trees brought counts once; a query keeps its best k + 1 classes, then ids
    single = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    # the best scores first, with all that tie with the last of them; then their ids
    scores = Window.partitionBy("query").orderBy(F.desc("score"))
    single = single.withColumn("_place", F.rank().over(scores)).filter(F.col("_place") <= k + 1).drop("_place")
    single = single.join(classes.select("class", "ids"), "class").withColumn("_least", F.col("ids")[0])
    order = Window.partitionBy("query").orderBy(F.desc("score"), "_least")
    best = single.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k + 1)
    entries = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id")))
    lists = best.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list(entries))), 1, k + 1).alias("_near"))
    lists = store.written(lists, "near")
    own = asked.join(lists.withColumnRenamed("query", "class"), "class")
    others = F.slice(F.filter("_near", lambda e: e["vec_id"] != F.col("vec_id")), 1, k)
    rows = own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("_rank", "_entry"))
    store.dropped(members)
    return rows.select("query_id", (F.col("_rank") + 1).cast("int").alias("rank"), F.col("_entry.vec_id").alias("vec_id"), (-F.col("_entry.minus")).alias("score"))
