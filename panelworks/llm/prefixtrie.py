"""A prefix trie over conversations, built by van Emde Boas recursion on the depth.

A node of depth d is a distinct sequence of d first turns (role, text); the textless root has depth 0.
Sequences are cut at half depth, so a block of 2 ** k levels is an upper trie of 2 ** (k - 1) levels
and a forest below it, one lower trie for each cut prefix. All tries of one level of the recursion are worked
on at once, as rows, so the rounds grow with the logarithm of the longest conversation and the
rows of all rounds together with the number of turns.

1. Naming, upwards: two neighbouring segments of a conversation are named by the digest of their
   names, until one name stands for the whole conversation. A segment that many conversations hold
   is known once. A conversation takes part up to the level that holds it and no further.
2. Cutting, downwards: a unit is a segment below a prefix (root of its block). It falls into the
   segment above the cut, below the same prefix, and the one below the cut, below the longer prefix. Equal
   units become one, with the number of their conversations and the smallest id. The units of one turn are
   the nodes.
3. Totals, upwards: the sum over a block is that of its upper trie and those of the lower tries.
4. Grafting, downwards: a cut prefix takes the total of its own lower trie, and the known totals of
   the prefixes that are cut off at the end of that one. At the end every node has the total of its subtree.

Turns are put in order by ranges, and conversations by the digest of their sequence, so neither one long
conversation nor many equal ones meet in one task. A name is 128 bits of a SHA-256 digest.

Turns are ordered by ``turn`` (null first), ties by the digest of role and text. A null role or text is
empty. Rows without a conv_id are left out. Other columns are not looked at. An empty table has no nodes, not
even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import store

#: Bytes of joined ids that go on as one row.
CHUNK_BYTES = 1 << 16


def digest(*parts: Column) -> Column:
    """128 bits of the SHA-256 digest of joined names."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turn_name(role: Column, text: Column) -> Column:
    """The name of a turn; the length of the role keeps role and text apart."""
    return digest(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"))


def reserved(byte: str) -> Column:
    """Names that no digest has to give: that of the root and that of the empty sequence."""
    return F.unhex(F.lit(byte * 16))


ROOT, EMPTY = "00", "ff"


@dataclass
class Trie:
    """The nodes, and the conversations that end at each of them.

    ``nodes``: node, parent (names), depth, conv_id (smallest member), parent_conv_id, turn (name of the last turn),
    n_convs, n_children, n_leaves, saved_tokens. ``ends``: node, conv_id.
    """

    nodes: DataFrame
    ends: DataFrame


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, turn, chars) of every turn, counted from 0, and (conv_id, n) of every conversation.

    The rows are sorted by ranges of (conv_id, turn); a conversation may lie in many ranges, each of
    which knows how many of its turns come before.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_order"), turn_name(role, text).alias("turn"), F.length(text).cast("long").alias("chars")
    )
    turns = store.written(turns.withColumn("_row", F.monotonically_increasing_id()), "turns")
    keys = [F.col("conv_id"), F.col("_order").asc_nulls_first(), F.col("turn"), F.col("_row")]
    placed = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_order", "_row")
    placed = placed.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    placed = store.written(placed, "placed-turns")
    parts = placed.groupBy("conv_id", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = store.written(parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "parts")
    pos = F.col("_place") - F.col("_first") + F.col("_before")
    found = placed.join(parts, ["conv_id", "_part"]).select("conv_id", pos.alias("pos"), "turn", "chars")
    found = store.written(found, "numbered-turns")
    sizes = store.written(parts.groupBy("conv_id").agg(F.sum("_n").alias("n")), "conversations")
    store.dropped(turns, placed, parts)
    return found, sizes


def whole_sequences(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences (conv_id, size, pos, turn, chars) and (conv_id, size) of conversations as they are."""
    sizes = sizes.select("conv_id", F.col("n").alias("size"))
    return turns.join(sizes, "conv_id").select("conv_id", "size", "pos", "turn", "chars"), sizes


def with_shared_heads(turns: DataFrame, sizes: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the one that opens their block of ``every`` ids.

    Conversation c gets the first h turns of conversation c - c % every (all if there are fewer, none if there
    is no such conversation), then its own turns after the first h; h = crc32(c) % most. A head turn is
    copied to the conversations of one block only.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = sizes.select(F.col("conv_id").alias("_base"), F.col("n").alias("_base_n"))
    plan = sizes.select("conv_id", "n", head.alias("_h"), (F.col("conv_id") - F.col("conv_id") % every).alias("_base"))
    got = F.least("_h", F.coalesce("_base_n", F.lit(0)))
    plan = plan.join(base, "_base", "left").select("conv_id", "_base", "_h", got.alias("_got"), (got + F.greatest(F.col("n") - F.col("_h"), F.lit(0))).alias("size"))
    plan = store.written(plan, "plan")
    heads = turns.filter(F.col("pos") < most).withColumnRenamed("conv_id", "_base")
    heads = plan.filter("_got > 0").join(heads, "_base").filter("pos < _got").select("conv_id", "size", "pos", "turn", "chars")
    own = turns.join(plan, "conv_id").filter("pos >= _h").select("conv_id", "size", (F.col("pos") - F.col("_h") + F.col("_got")).alias("pos"), "turn", "chars")
    return heads.unionByName(own), plan.select("conv_id", "size")


def _named(sequences: DataFrame, levels: int) -> list[DataFrame]:
    """For each level k, the segments of 2 ** k turns of the conversations that need it."""
    rows = [store.written(sequences.select("conv_id", "size", "pos", F.col("turn").alias("name"), "chars"), "segments-0")]
    for k in range(1, levels + 1):
        half = F.struct("name", "chars")
        pairs = rows[-1].filter(F.col("size") > 2 ** (k - 1)).groupBy("conv_id", "size", F.expr("pos div 2").alias("pos"))
        two = pairs.agg(F.max(F.when(F.expr("pos % 2 = 0"), half)).alias("left"), F.max(F.when(F.expr("pos % 2 = 1"), half)).alias("right"))
        name = digest(F.col("left.name"), F.coalesce("right.name", F.unhex(F.lit(""))))
        rows.append(store.written(two.select("conv_id", "size", "pos", name.alias("name"), F.coalesce("right.chars", "left.chars").alias("chars"), "left", "right"), f"segments-{k}"))
    return rows


def _complete(segments: DataFrame, k: int) -> DataFrame:
    """Conversations whose whole sequence is one segment of this level: (name, size, chars, conv_id)."""
    return segments.filter(F.col("size") <= 2**k).select("name", "size", "chars", "conv_id")


def _units(named: list[DataFrame]) -> list[DataFrame]:
    """For each level k, the distinct segments below the prefixes that begin a block of that level.

    (prefix, depth, name, end, size, chars, n_convs, conv_id, whole, above): ``end`` names the longer prefix at the end
    of the segment, ``whole`` the sequence that ends in it, and ``above`` is the prefix that begins the block of
    the next level if that is another one.
    """
    levels = len(named) - 1
    units: list[DataFrame] = [named[0]] * len(named)
    for k in range(levels, -1, -1):
        unit = ["prefix", "depth", "name", "end", "size", "chars", "n_convs", "conv_id", "whole", "above"]
        none = F.lit(None).cast("binary")
        entering = _complete(named[k], k).groupBy("name", "size", "chars").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
        rows = entering.select(reserved(ROOT).alias("prefix"), F.lit(0).cast("long").alias("depth"), "name", digest(reserved(ROOT), F.col("name")).alias("end"), "size", "chars", "n_convs", "conv_id", F.col("name").alias("whole"), none.alias("above"))
        if k < levels:
            half = F.lit(2**k).cast("long")
            halves = named[k + 1].groupBy("name").agg(F.first("left").alias("left"), F.first("right").alias("right"))
            both = units[k + 1].drop("chars", "above").join(store.written(halves, "halves"), "name")
            past = F.col("size") > half
            cut = digest(F.col("prefix"), F.col("left.name"))
            upper = F.struct("prefix", "depth", F.col("left.name").alias("name"), F.when(F.col("size") >= half, cut).otherwise(F.col("end")).alias("end"), F.least("size", half).alias("size"), F.col("left.chars").alias("chars"), "n_convs", "conv_id", F.when(~past, F.col("whole")).alias("whole"), none.alias("above"))
            lower = F.struct(cut.alias("prefix"), (F.col("depth") + half).alias("depth"), F.col("right.name").alias("name"), "end", (F.col("size") - half).alias("size"), F.col("right.chars").alias("chars"), "n_convs", "conv_id", "whole", F.col("prefix").alias("above"))
            fallen = both.select(F.explode(F.when(past, F.array(upper, lower)).otherwise(F.array(upper))).alias("_u")).select("_u.*")
            rows = fallen.select(*unit).union(rows.select(*unit))
        same = rows.groupBy("prefix", "name").agg(
            *(F.first(c).alias(c) for c in ("depth", "end", "size", "chars")), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("whole").alias("whole"), F.max("above").alias("above")
        )
        units[k] = store.written(same.select(*unit), f"units-{k}")
    return units


def _subtrees(units: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """(node, _leaves, _saved): sums over all nodes below each prefix that has some."""
    totals = [F.sum(c).alias(c) for c in ("_leaves", "_saved")]
    blocks = [store.written(nodes.groupBy(F.col("parent").alias("node")).agg(*totals), "blocks-0")]
    levels = len(units) - 1
    cuts = []
    for k in range(1, levels + 1):
        cut = units[k - 1].filter("above IS NOT NULL").groupBy(F.col("prefix").alias("node")).agg(F.first("above").alias("above"))
        cuts.append(store.written(cut, f"cuts-{k}"))
        up = blocks[-1].join(cuts[-1], "node", "left").select(F.coalesce("above", "node").alias("node"), "_leaves", "_saved")
        blocks.append(store.written(up.groupBy("node").agg(*totals), f"blocks-{k}"))
    known = blocks[-1]
    for k in range(levels, 0, -1):
        ends = units[k - 1].filter((F.col("size") == 2 ** (k - 1)) & F.col("above").isNotNull())
        ends = ends.select(F.col("prefix").alias("_to"), F.col("end").alias("node"))
        grafts = ends.join(known, "node").select(F.col("_to").alias("node"), "_leaves", "_saved")
        own = blocks[k - 1].join(cuts[k - 1].select("node"), "node", "left_semi")
        full = own.unionByName(grafts).groupBy("node").agg(*totals)
        known_next = store.written(known.unionByName(full), f"subtrees-{k}")
        store.dropped(known, cuts[k - 1])
        known = known_next
    store.dropped(*blocks[:levels])
    return known


def trie(sequences: DataFrame, sizes: DataFrame) -> Trie:
    """The trie of ``sequences`` (conv_id, size, pos, turn, chars); ``sizes`` (conv_id, size) has the turnless ones as well."""
    sizes = store.written(sizes.select("conv_id", F.col("size").cast("long").alias("size")), "sizes")
    longest = sizes.agg(F.max("size")).first()[0] or 0
    levels = max(0, longest - 1).bit_length()
    named = _named(sequences, levels)
    units = _units(named)
    flat = units[0].select(
        F.col("end").alias("node"),
        F.col("prefix").alias("parent"),
        (F.col("depth") + 1).alias("depth"),
        F.col("name").alias("turn"),
        "chars",
        "n_convs",
        "conv_id",
        "whole",
    )
    children = store.written(units[0].groupBy(F.col("prefix").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    top = sizes.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = top.select(reserved(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("chars"), "n_convs", "conv_id", reserved(EMPTY).alias("whole"))
    weighted = flat.unionByName(root).join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    weighted = weighted.withColumn("_leaves", (F.col("n_children") == 0).cast("long")).withColumn("_saved", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = store.written(weighted, "nodes")
    below = _subtrees(units, nodes.filter("parent IS NOT NULL"))
    below = below.select("node", F.col("_leaves").alias("_more_leaves"), F.col("_saved").alias("_more_saved"))
    parents = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(below, "node", "left").join(parents, "parent", "left")
    total = lambda own, more: F.col(own) + F.coalesce(more, F.lit(0))
    whole = whole.select(
        *("node", "parent", "depth", "conv_id", "parent_conv_id", "turn", "n_convs", "n_children"),
        total("_leaves", "_more_leaves").alias("n_leaves"),
        total("_saved", "_more_saved").alias("saved_tokens"),
        "whole",
    )
    whole = store.written(whole, "trie")
    ended = sizes.filter("size = 0").select(reserved(EMPTY).alias("whole"), "conv_id")
    for k in range(levels + 1):
        ended = ended.union(_complete(named[k], k).select(F.col("name").alias("whole"), "conv_id"))
    ends = store.written(whole.filter("whole IS NOT NULL").select("node", "whole").join(store.written(ended, "ends"), "whole").select("node", "conv_id"), "node-ends")
    store.dropped(*named, *units, children, nodes, below, sizes)
    return Trie(whole.drop("whole"), ends)


def id_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ids of each node, ascending and joined by commas.

    The ids are sorted and joined by ranges, into chunks of at most ``CHUNK_BYTES``; only the joined chunks of
    a node are read one after another, since a digest has to see its bytes in order. Never more than one is held.
    """
    keys = ["node", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(node, first, ids):
            return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "conv_id": pa.array([first], pa.int64()), "ids": pa.array([",".join(ids)])})

        held, first, ids, size = None, 0, [], 0
        for batch in batches:
            for node, i in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (node != held or size > CHUNK_BYTES):
                    yield row(held, first, ids)
                    ids, size = [], 0
                if not ids:
                    held, first = node, i
                ids.append(str(i))
                size += len(ids[-1]) + 1
        if ids:
            yield row(held, first, ids)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == held:
                    state.update(b",")
                else:
                    if state is not None:
                        nodes.append(held)
                        digests.append(state.hexdigest())
                    held, state = node, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "ends_sha256": pa.array(digests, pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([held], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})

    chunks = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(joined, "node binary, conv_id long, ids string")
    dealt = store.written(chunks, "id-chunks").repartition("node").sortWithinPartitions(*keys)
    return dealt.mapInArrow(hashed, "node binary, ends_sha256 string")


def node_report(built: Trie) -> DataFrame:
    """One row for each node, with the digest of the ids that end there."""
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    found = built.nodes.join(store.written(id_digests(built.ends), "end-digests"), "node", "left")
    return found.select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
