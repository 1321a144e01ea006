"""Ordered windows that stay parallel when one group holds much of the data.

A window function puts each group into one task. That is right for a panel with
many entities, and wrong as soon as one entity holds a third of all rows. The
helpers here count the groups first. When all of them fit, they build the plain
window (one shuffle). Otherwise only the hot groups are cut into ranges of the
window order:

* the hot rows are range-partitioned by (keys, order) and numbered inside each
  partition; every ``hot_rows / 2`` of them are a chunk, made stable by a checkpoint.
  How many partitions there are follows the bytes, not the limit, so many small hot
  groups make many chunks but no more tasks;
* a bounded frame needs at most ``before``/``after`` neighbours, so each chunk
  receives copies of the last/first rows of its neighbour chunks (the halo);
* a running total needs one number per earlier chunk, so chunk totals are summed
  up and added to the total inside the chunk.

A job with many windows of the same groups lays its rows out once (``lay_out``) and hands that layout to
every operator: the chunk numbers stay in the rows, and what an operator needs of other chunks comes from the
stored rows, so nothing is counted, cut or computed again.

All give the same values as the plain window, for every frame size. What is
brought together per group is only the chunk summary, a few rows per
``hot_rows / 2`` rows of data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.session import persist_point, stored_table

#: Most bytes of rows that one group may bring into one task, by the width of the schema.
HOT_BYTES = 512 << 20
#: Bytes of hot rows that one task cuts into chunks, where that takes fewer tasks than a chunk each.
RANGE_BYTES = 64 << 20
#: Pass as ``hot_rows`` where the caller has counted the groups already.
UNCHECKED = -1

CHUNK = "_chunk"
HALO = "_halo"

Build = Callable[[WindowSpec], Sequence[Column]]


def row_bytes(schema: T.StructType) -> int:
    """Bytes of a row by the types of its columns; 32 for each text or nested value."""
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    eight = (T.LongType, T.DoubleType, T.TimestampType)
    return sum(fixed.get(type(f.dataType), 8 if isinstance(f.dataType, eight) else 32) for f in schema.fields)


def hot_rows_limit(df: DataFrame, hot_rows: int | None) -> int:
    """Rows of one group that fit into ``HOT_BYTES``; ``spark.panelworks.hotRows`` sets them outright."""
    if hot_rows is not None:
        return hot_rows
    fit = HOT_BYTES // max(1, row_bytes(df.schema))
    return int(df.sparkSession.conf.get("spark.panelworks.hotRows", str(fit)))


@dataclass(frozen=True)
class HotGroups:
    """Keys of the groups above the limit; at most total rows / limit of them."""

    keys: DataFrame
    groups: int
    rows: int
    limit: int


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> HotGroups | None:
    """Count rows per group (map-side combined) and return the ones over the limit."""
    limit = hot_rows_limit(df, hot_rows)
    if limit == UNCHECKED:
        return None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    over = sizes.filter(F.col("_rows") > limit)
    total = over.agg(F.count(F.lit(1)).alias("g"), F.sum("_rows").alias("r")).first()
    if not total["g"]:
        return None
    return HotGroups(stored_table(over), total["g"], total["r"], limit)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet, as they do in a group or a window."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


@dataclass(frozen=True)
class SplitGroups:
    """The input as cold rows plus the hot rows cut into chunks."""

    cold: DataFrame
    hot: DataFrame
    keys: list[str]
    order: list[str]

    @property
    def chunk_keys(self) -> list[str]:
        return [*self.keys, CHUNK]

    def with_halo(self, before: int, after: int) -> DataFrame:
        """All rows with chunk number, plus the halo copies each chunk needs."""
        whole = [self.hot, self.cold.withColumn(CHUNK, F.lit(-1))]
        parts = [part.withColumn(HALO, F.lit(False)) for part in whole]
        if before:
            parts.append(self._halo(before, last=True))
        if after:
            parts.append(self._halo(after, last=False))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _halo(self, depth: int, last: bool) -> DataFrame:
        columns = [c for c in self.hot.columns if c not in self.chunk_keys]
        ordering = [F.col(c).desc() if last else F.col(c).asc() for c in self.order]
        edge = (
            self.hot.withColumn(
                "_edge", F.row_number().over(Window.partitionBy(*self.chunk_keys).orderBy(*ordering))
            )
            .filter(F.col("_edge") <= depth)
            .groupBy(*self.chunk_keys)
            .agg(
                F.sort_array(
                    F.collect_list(F.struct("_edge", F.struct(*columns).alias("_row"))),
                ).alias("_rows")
            )
        )
        # every chunk holds at least one row, so ``depth`` neighbours always do
        frame = Window.partitionBy(*self.keys).orderBy(F.col(CHUNK).desc() if not last else F.col(CHUNK))
        near = F.reverse(F.collect_list("_rows").over(frame.rowsBetween(-depth, -1)))
        return (
            edge.withColumn("_near", F.slice(F.flatten(near), 1, depth))
            .select(*self.chunk_keys, F.explode("_near").alias("_item"))
            .select(*self.chunk_keys, *[F.col(f"_item._row.{c}").alias(c) for c in columns])
            .withColumn(HALO, F.lit(True))
        )

    def earlier_totals(self, aggregates: dict[str, Column]) -> DataFrame:
        """Per chunk: the sum of each aggregate over the earlier chunks of its group."""
        totals = self.hot.groupBy(*self.chunk_keys).agg(
            *[c.alias(name) for name, c in aggregates.items()]
        )
        frame = (
            Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )
        return totals.select(
            *self.chunk_keys, *[F.sum(name).over(frame).alias(name) for name in aggregates]
        )


def _cut(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotGroups
) -> tuple[DataFrame, DataFrame]:
    """The cold rows, and the hot rows with their chunk number (to be stored before use)."""
    lookup = hot.keys.select(*keys)
    cold = null_safe_join(df, lookup, keys, "left_anti")
    rows = null_safe_join(df, lookup, keys, "left_semi")
    ranged = rows.repartitionByRange(range_tasks(df, hot), *keys, *order).sortWithinPartitions(*keys, *order)
    numbered = ranged.withColumn(CHUNK, F.monotonically_increasing_id())
    # rows of equal order stay in one chunk, that of the first of them; the ranges hold them together already
    first = F.min(CHUNK).over(Window.partitionBy(*dict.fromkeys([*keys, *order])))
    place = first.bitwiseAND(F.lit((1 << 33) - 1))  # inside the partition; its number is in the bits above
    chunk = first - place + F.floor(place / max(1, hot.limit // 2))
    return cold, numbered.withColumn(CHUNK, chunk)


def range_tasks(df: DataFrame, hot: HotGroups) -> int:
    """Tasks that cut the hot rows: one for each chunk, but no more than their bytes or the cluster ask for."""
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_bytes = -(-hot.rows * row_bytes(df.schema) // RANGE_BYTES)
    return min(max(2, -(-2 * hot.rows // hot.limit)), max(shuffled, by_bytes))


def split_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotGroups
) -> SplitGroups:
    """Cut the hot groups into contiguous ranges of the window order."""
    keys, order = list(keys), list(order)
    cold, ranged = _cut(df, keys, order, hot)
    return SplitGroups(cold, persist_point(ranged), keys, order)


@dataclass(frozen=True)
class Layout:
    """Stored rows, cut once along ``order`` of the groups of ``keys``; chunk -1 holds what is not hot.

    It serves every window whose keys begin with ``keys`` and whose order follows ``order``: a chunk of the whole
    group is then a range of each smaller group as well. ``rows`` gives the rows to work on; they keep
    the column ``CHUNK`` until the job drops it, and further columns may be added to them.
    """

    stored: DataFrame
    keys: list[str]
    order: list[str]

    def rows(self) -> DataFrame:
        """One shuffle for the windows of all keys."""
        return self.stored.repartition(*self.keys, CHUNK)

    def split(self, keys: Sequence[str]) -> SplitGroups:
        """The hot rows as they were stored, seen as the groups of ``keys``."""
        hot = self.stored.filter(F.col(CHUNK) >= 0)
        return SplitGroups(self.stored.limit(0), hot, list(keys), self.order)

    def halo(self, keys: Sequence[str], before: int, after: int) -> DataFrame | None:
        split = self.split(keys)
        parts = [split._halo(n, last) for n, last in ((before, True), (after, False)) if n]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None

    def earlier(self, keys: Sequence[str], value: str) -> DataFrame:
        """Per chunk and group: sum and count of ``value`` in the earlier chunks, and its value in the last row there."""
        by = [*keys, CHUNK]
        totals = self.split(keys).hot.groupBy(*by).agg(
            F.sum(value).alias("_sum_before"),
            F.count(value).alias("_count_before"),
            F.max_by(F.struct(value), F.struct(*self.order)).alias("_last_before"),
        )
        frame = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(
            *by,
            F.sum("_sum_before").over(frame).alias("_sum_before"),
            F.sum("_count_before").over(frame).alias("_count_before"),
            F.last("_last_before").over(frame)[value].alias("_last_before"),
        )


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotGroups) -> Layout:
    """Cut the hot groups once; all rows are stored with their chunk number."""
    cold, ranged = _cut(df, keys, order, hot)
    rows = ranged.unionByName(cold.withColumn(CHUNK, F.lit(-1)))
    return Layout(stored_table(rows), list(keys), list(order))


def apply_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Build,
    before: int = 0,
    after: int = 0,
    hot_rows: int | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` rows back and ``after`` ahead.

    All columns of ``build`` share one window, hence one shuffle and one sort. With a ``layout``, ``df`` holds its
    rows, and ``build`` takes only columns that the layout was made with.
    """
    if layout is not None:
        rows, halo = df.withColumn(HALO, F.lit(False)), layout.halo(keys, before, after)
        if halo is not None:
            rows = rows.unionByName(halo, allowMissingColumns=True)
        window = Window.partitionBy(*keys, CHUNK).orderBy(*order)
        return rows.select("*", *build(window)).filter(~F.col(HALO)).drop(HALO)
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return df.select("*", *build(Window.partitionBy(*keys).orderBy(*order)))
    split = split_groups(df, keys, order, hot)
    rows = split.with_halo(before, after)
    window = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    return rows.select("*", *build(window)).filter(~F.col(HALO)).drop(CHUNK, HALO)


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    sum_as: str,
    count_as: str | None = None,
    previous_as: str | None = None,
    hot_rows: int | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Sum and count of ``value`` over the earlier rows of the group.

    The sum is null where no earlier row has a value; the count is then 0.
    ``previous_as`` adds the value of the row just before. With a ``layout``, ``df`` holds its rows, and
    ``value`` is a column that the layout was made with.
    """

    def columns(window: WindowSpec, own: Column) -> list[Column]:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        added = [F.sum(own).over(earlier).alias(sum_as)]
        if count_as:
            added.append(F.count(own).over(earlier).alias(count_as))
        if previous_as:
            added.append(F.lag(value, 1).over(window).alias(previous_as))
        return added

    def with_earlier(inside: DataFrame, offsets: DataFrame) -> DataFrame:
        joined = null_safe_join(inside, offsets, [*keys, CHUNK], "left")
        added = F.coalesce(F.col("_sum_before") + F.col(sum_as), F.col("_sum_before"), F.col(sum_as))
        result = joined.withColumn(sum_as, added)
        if count_as:
            result = result.withColumn(
                count_as, F.col(count_as) + F.coalesce(F.col("_count_before"), F.lit(0))
            )
        return result

    if layout is not None:
        window = Window.partitionBy(*keys, CHUNK).orderBy(*order)
        inside = df.select("*", *columns(window, F.col(value)), F.row_number().over(window).alias("_place"))
        result = with_earlier(inside, stored_table(layout.earlier(keys, value)))
        if previous_as:
            first = F.col("_place") == 1
            result = result.withColumn(previous_as, F.when(first, F.col("_last_before")).otherwise(F.col(previous_as)))
        return result.drop("_place", "_sum_before", "_count_before", "_last_before")
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *columns(window, F.col(value)))
    split = split_groups(df, keys, order, hot)
    rows = split.with_halo(1 if previous_as else 0, 0)
    window = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    inside = rows.select("*", *columns(window, F.when(~F.col(HALO), F.col(value)))).filter(~F.col(HALO))
    totals = {"_sum_before": F.sum(value), "_count_before": F.count(value)}
    offsets = split.earlier_totals(totals)
    result = with_earlier(inside, offsets)
    return result.drop(CHUNK, HALO, "_sum_before", "_count_before")


def attach(df: DataFrame, lookup: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join of a derived lookup table.

    The lookup is computed once and stored, so the planner knows its size in bytes
    and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` only. A larger
    one meets the rows in a shuffle, where adaptive execution splits the partition
    of a hot key; it can do that only for a side that is shuffled as it is, which
    is why the lookup is stored before the join.
    """
    table = stored_table(lookup)
    if null_safe:
        return null_safe_join(df, table, on, "left")
    return df.join(table, list(on), "left")
