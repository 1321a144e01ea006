"""Removal of byte strings that occur more than once, by deep-shallow sorting of suffixes.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else in the
corpus, in the same text or another one. Strings are judged on the input, not on what is left.

1. Each window of ``length`` bytes names one place in it, the one whose run of ``GRAM`` bytes has the
   smallest hash. Equal windows name places with equal runs, at the same distance from the start,
   and neighbouring windows mostly share their place: about two places in ``length`` bytes.
2. Places whose run occurs once in the corpus are left out. For the others, the bytes of all windows
   that name the place (its context) are brought together by that run; equal contexts meet in the
   map tasks already and are one context with a count.
3. The contexts of a run are put in suffix order twice: by what follows the place, and by what
   comes before it, read backwards. Deep-shallow sorting: a multikey quicksort on words of eight
   bytes to a shallow depth, then a blind trie for each group that is still tied. The common
   prefixes of neighbours in both orders tell, for each distance, which windows are equal.
   A run with very many contexts is dealt by a longer run: windows whose place is about equally far from their
   start have most of their bytes in common positions, and equal windows agree on those. The pieces of the
   contexts are sorted in the same way, and dealt again, down to single windows, where a run still has too many.
4. The covered ranges go back to their texts.

Null and empty texts, and texts shorter than ``length``, lose nothing. Every row is a text of its own:
rows that repeat an id and a text repeat each other. Bytes that remain are joined; where a removed range
ends inside a character, ``without_repeats`` drops the rest of that character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.llm import store
from panelworks.llm import text as T

LENGTH = 400
#: Bytes of the run that names a place.
GRAM = 64
#: Bytes ordered by the multikey quicksort.
SHALLOW = 72
#: Contexts sorted at a time; a longer group of one run is sorted as a whole.
CHUNK = 8192
#: Distinct contexts of one run above which it is dealt by longer runs.
HOT_CONTEXTS = 2048
#: Windows that share a longer run, as parts of ``length``; the last longer run is the window itself.
FINER = (8, LENGTH)

PLACE_BITS = np.uint64(24)
PLACE_MASK = np.uint64((1 << 24) - 1)
#: Windows of one text worked on at a time.
WINDOWS = 1 << 22


# ---- places -------------------------------------------------------------------------------


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by running minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def places(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, place, first window, last window, run hash) of the places that windows name.

    Positions count from the start of the text.
    """
    found = []
    whole = np.diff(offsets)
    if len(data) >= length and whole.max(initial=0) >= length:
        for lo in range(0, len(data) - length + 1, WINDOWS):
            found.append(_places(data[lo : lo + WINDOWS + length - 1], offsets, lo, length, gram))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _places(data: np.ndarray, offsets: np.ndarray, base: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    runs = np.arange(len(data) - gram + 1)
    h = T.word_hashes(data, runs, runs + gram)
    low = sliding_min((h & ~PLACE_MASK) | runs.astype(np.uint64), length - gram + 1)
    at = (low & PLACE_MASK).astype(np.int64)
    start = np.arange(len(at)) + base
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[np.minimum(text + 1, len(offsets) - 1)]
    start, at, text = start[inside], at[inside], text[inside]
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    own = offsets[text[first]]
    return text[first], at[first] + base - own, start[first] - own, start[last] - own, h[at[first]]


# ---- deep-shallow sorting ------------------------------------------------------------------


def blind_trie(strings: list[bytes]) -> list[int]:
    """Order of ``strings`` by a trie that keeps only branching depths and branching bytes."""
    ordered: list[int] = []

    def byte(i: int, depth: int) -> int:
        return strings[i][depth] if depth < len(strings[i]) else -1

    root: list | int = 0
    same: dict[int, list[int]] = {0: [0]}
    width = max(map(len, strings))
    numbers = [int.from_bytes(s.ljust(width, b"\0"), "big") for s in strings]

    def common(i: int, j: int) -> int:
        differ = numbers[i] ^ numbers[j]
        equal = width - (differ.bit_length() + 7) // 8
        return min(equal, len(strings[i]), len(strings[j]))

    for i in range(1, len(strings)):
        # down to any leaf, without looking at the bytes between the branchings
        node = root
        while isinstance(node, list):
            node = node[1].get(byte(i, node[0])) if byte(i, node[0]) in node[1] else next(iter(node[1].values()))
        depth = common(i, node)
        if depth == len(strings[i]) == len(strings[node]):
            same[node].append(i)
            continue
        same[i] = [i]
        seen = node
        # the branching where the new string leaves the trie
        parent, node = None, root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][byte(i, node[0])]
        if isinstance(node, list) and node[0] == depth:
            node[1][byte(i, depth)] = i
            continue
        branch = [depth, {byte(seen, depth): node, byte(i, depth): i}]
        if parent is None:
            root = branch
        else:
            parent[1][byte(i, parent[0])] = branch
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            ordered.extend(same[node])
    return ordered


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Lexicographic order of ``strings``, and the common prefix of each with the one before it."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    width = max(8, -(-int(lengths.max(initial=0)) // 8) * 8)
    packed = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)
    order = np.arange(len(strings))
    rank = np.zeros(len(strings), np.int64)  # of each position in ``order``: number of its run of equals
    # multikey quicksort, a word of eight bytes at a time, on the runs that are still tied
    for word in range(min(shallow, width) // 8):
        size = np.bincount(rank)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        key = packed[order[tied], word * 8 : word * 8 + 8].copy().view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((key, rank[tied]))
        order[tied] = order[tied][by]
        key, run = key[by], rank[tied]
        new = np.zeros(len(order), np.int64)
        new[0] = 0
        new[1:] = rank[1:] != rank[:-1]
        inner = np.flatnonzero((run[1:] == run[:-1]) & (key[1:] != key[:-1])) + 1
        new[tied[inner]] = 1
        rank = np.cumsum(new)
    # blind tries for the groups with a longer common prefix
    starts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(order) else np.zeros(0, int)
    ends = np.append(starts[1:], len(order))
    for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
        group = order[a:b].copy()
        order[a:b] = group[blind_trie([strings[i] for i in group])]
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), CHUNK):
        b = min(len(order), a + CHUNK)
        x, y = packed[order[a - 1 : b - 1]], packed[order[a:b]]
        differs = x != y
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        common[a:b] = np.minimum(first, np.minimum(lengths[order[a - 1 : b - 1]], lengths[order[a:b]]))
    return order, common


def repeated_distances(
    contexts: list[bytes], at: np.ndarray, counts: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance of the place from the start of a repeated window, -1 if none.

    ``at`` is the place in each context. A context covers the windows that start at its first
    ``len - length + 1`` bytes.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    least, most = at - (sizes - length), at.copy()  # distances of the last and the first window
    low = np.where(counts > 1, least, -1)
    high = np.where(counts > 1, most, -1)
    if len(contexts) < 2 or (counts > 1).all():
        return low, high
    order_r, common_r = deep_shallow([c[p:] for c, p in zip(contexts, at)])
    order_l, common_l = deep_shallow([c[:p][::-1] for c, p in zip(contexts, at)])
    right, left = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    # equality classes change only at distances where a neighbour's common prefix ends
    steps = np.unique(np.concatenate([common_l + 1, length - common_r + 1, least, most + 1, length - common_r, common_l]))
    steps = steps[(steps >= 0) & (steps <= length - gram)]
    for distance in steps:
        right[order_r] = np.cumsum(common_r < length - distance)
        left[order_l] = np.cumsum(common_l < distance)
        live = np.flatnonzero((least <= distance) & (distance <= most))
        key = right[live] * (len(at) + 1) + left[live]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(live), bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        hit = live[twice]
        low[hit] = np.where(low[hit] < 0, distance, np.minimum(low[hit], distance))
        high[hit] = np.maximum(high[hit], distance)
    return low, high


# ---- Spark ---------------------------------------------------------------------------------


def _row_key() -> list[Column]:
    """What tells rows apart: id and text. Equal rows have equal results."""
    return [F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text")]


def _named_places(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        for batch in batches:
            for lo, _, data, offsets in T.byte_slices(batch.column("text")):
                row, at, first, last, run = places(data, offsets, length, gram)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column("_id").take(take),
                        "_text": batch.column("_text").take(take),
                        "_at": pa.array(at, pa.int64()),
                        "_first": pa.array((at - first).astype(np.int32), pa.int32()),
                        "_last": pa.array((at - last).astype(np.int32), pa.int32()),
                        "_run": pa.array(run.view(np.int64), pa.int64()),
                    }
                )

    return docs.select("text", *_row_key()).mapInArrow(
        made, "_id long, _text long, _at long, _first int, _last int, _run long"
    )


def _contexts(suspects: DataFrame, length: int) -> DataFrame:
    """(_run, _id, _text, _at, _ahead, _c1, _c2, _context) of each place of each suspect row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_buffer()
                data = np.frombuffer(text, np.uint8)
                named = batch.column("_places")[row].values
                at, first, last, run = (named.field(i).to_numpy() for i in range(4))
                lo, hi = at - first, at - last + length
                c1 = T.word_hashes(data, lo, hi)
                c2 = T.span_hashes(T.mixed(data.astype(np.uint64) + np.uint64(0x51ED27)), lo, hi)
                n = len(at)
                raw = text.to_pybytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "_run": pa.array(run, pa.int64()),
                        "_id": pa.array(np.full(n, batch.column("_id")[row].as_py()), pa.int64()),
                        "_text": pa.array(np.full(n, batch.column("_text")[row].as_py()), pa.int64()),
                        "_at": pa.array(at, pa.int64()),
                        "_ahead": pa.array(first, pa.int32()),
                        "_c1": pa.array((c1 + first.astype(np.uint64)).view(np.int64), pa.int64()),
                        "_c2": pa.array(c2.view(np.int64), pa.int64()),
                        "_context": pa.array([raw[a:b] for a, b in zip(lo, hi)], pa.binary()),
                    }
                )

    return suspects.mapInArrow(
        made, "_run long, _id long, _text long, _at long, _ahead int, _c1 long, _c2 long, _context binary"
    )


def _sorted_runs(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """(_c1, _c2, _low, _high) of the distinct contexts with repeated windows."""
    dealt = contexts.repartition("_run").sortWithinPartitions("_run")

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        held: list[pa.RecordBatch] = []
        rows = 0

        def judged(table: pa.Table) -> pa.RecordBatch:
            run = table.column("_run").to_numpy()
            count = table.column("_count").to_numpy()
            at = table.column("_ahead").to_numpy().astype(np.int64)
            sizes = table.column("_size").to_numpy()
            low = np.where(count > 1, at - (sizes - length), -1)
            high = np.where(count > 1, at, -1)
            new = np.concatenate([[True], run[1:] != run[:-1]])
            group = np.cumsum(new) - 1
            several = np.flatnonzero((np.bincount(group) > 1)[group])
            if len(several):
                strings = table.column("_context").take(pa.array(several)).to_pylist()
                low[several], high[several] = repeated_distances(strings, at[several], count[several], length, gram)
            keep = pa.array(high >= 0)
            out = pa.RecordBatch.from_arrays(
                [
                    table.column("_c1").combine_chunks(),
                    table.column("_c2").combine_chunks(),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                ],
                names=["_c1", "_c2", "_low", "_high"],
            )
            return out.filter(keep)

        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= CHUNK:
                run = batch.column("_run").to_numpy()
                before = held[-1].column("_run")[held[-1].num_rows - 1].as_py()
                cut = int(np.searchsorted(run, before, "right")) if run[0] == before else 0
                if cut < batch.num_rows:
                    yield judged(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held, rows, batch = [], 0, batch.slice(cut)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield judged(pa.Table.from_batches(held))

    return dealt.mapInArrow(sorted_, "_c1 long, _c2 long, _low long, _high long")


def _pieces(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """Contexts cut into their windows with the place at ``width`` neighbouring distances, as contexts of a longer run.

    All windows of a piece, whole or not, hold the same ``length - width + 1`` bytes around the place. (_p1, _p2)
    is the context that was cut.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column("_context")[row].as_buffer().to_pybytes()
                data = np.frombuffer(raw, np.uint8)
                other = T.mixed(data.astype(np.uint64) + np.uint64(0x51ED27))
                most = batch.column("_ahead")[row].as_py()
                least = most - (len(raw) - length)
                nearest = np.arange(least // width, most // width + 1) * width
                farthest = nearest + width - 1
                run = T.word_hashes(data, most - nearest, most - farthest + length)
                run = T.mixed(run + T.mixed(nearest.astype(np.uint64) + np.uint64(batch.column("_run")[row].as_py() % (1 << 64))))
                far = np.minimum(farthest, most)
                lo, hi = most - far, most - np.maximum(nearest, least) + length
                c1 = T.word_hashes(data, lo, hi) + far.astype(np.uint64)
                c2 = T.span_hashes(other, lo, hi)
                n = len(run)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_p1": pa.array(np.full(n, batch.column("_c1")[row].as_py()), pa.int64()),
                        "_p2": pa.array(np.full(n, batch.column("_c2")[row].as_py()), pa.int64()),
                        "_run": pa.array(run.view(np.int64), pa.int64()),
                        "_c1": pa.array(c1.view(np.int64), pa.int64()),
                        "_c2": pa.array(c2.view(np.int64), pa.int64()),
                        "_ahead": pa.array(far.astype(np.int32), pa.int32()),
                        "_count": pa.array(np.full(n, batch.column("_count")[row].as_py()), pa.int64()),
                        "_context": pa.array([raw[x:y] for x, y in zip(lo, hi)], pa.binary()),
                    }
                )

    return contexts.mapInArrow(
        made, "_p1 long, _p2 long, _run long, _c1 long, _c2 long, _ahead int, _count long, _context binary"
    )


def _distinct(contexts: DataFrame, count: Column) -> DataFrame:
    """Equal contexts of a run as one with their number."""
    return (
        contexts.groupBy("_c1", "_c2", "_run", "_ahead")
        .agg(count.alias("_count"), F.first("_context").alias("_context"))
        .withColumn("_size", F.octet_length("_context").cast("long"))
    )


def _judged(single: DataFrame, length: int, gram: int, hot_contexts: int, finer: tuple[int, ...]) -> DataFrame:
    """A stored table (_c1, _c2, _low, _high) of the contexts with repeated windows.

    Runs with more than ``hot_contexts`` contexts are dealt by longer runs, in steps of ``finer``. At the last
    one the longer run is a whole window, so all contexts of a run are equal and have met already.
    """
    if not finer:
        return store.written(_sorted_runs(single, length, gram), "judged")
    sizes = single.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    hot = store.written(sizes.filter(F.col("_n") > hot_contexts).select("_run"), "hot-runs")
    judged = store.written(_sorted_runs(single.join(hot, "_run", "left_anti"), length, gram), "judged")
    if hot.isEmpty():
        store.dropped(hot)
        return judged
    width = max(1, length // finer[0])
    pieces = store.written(_pieces(single.join(hot, "_run", "left_semi"), length, width), "pieces")
    cut = store.written(_distinct(pieces, F.sum("_count")), "contexts")
    below = _judged(cut, length, gram, hot_contexts, finer[1:])
    found = (
        pieces.select("_p1", "_p2", "_c1", "_c2")
        .join(below, ["_c1", "_c2"])
        .groupBy(F.col("_p1").alias("_c1"), F.col("_p2").alias("_c2"))
        .agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    )
    both = store.written(judged.unionByName(found), "judged")
    store.dropped(hot, judged, pieces, cut, below)
    return both


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_contexts: int = HOT_CONTEXTS
) -> tuple[DataFrame, DataFrame]:
    """Rows with repeated strings: (_id, _text, text, _ranges), and a table to drop afterwards.

    ``_ranges`` are (start, end) byte ranges that may overlap. Rows that are equal come once each.
    """
    named = store.written(_named_places(docs, length, gram), "places")
    runs = store.written(
        named.groupBy("_run").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_run"), "runs"
    )
    by_row = (
        named.join(runs, "_run")
        .groupBy("_id", "_text")
        .agg(F.collect_set(F.struct("_at", "_first", "_last", "_run")).alias("_places"))
    )
    by_row = store.written(by_row, "row-places")
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), *_row_key()).join(by_row, ["_id", "_text"])
    suspects = store.written(rows.select("_id", "_text", "text", "_places"), "suspects")
    store.dropped(named, runs, by_row)

    contexts = _contexts(suspects, length)
    single = store.written(_distinct(contexts, F.count(F.lit(1))), "contexts")
    judged = _judged(single, length, gram, hot_contexts, FINER)
    ranges = (
        contexts.select("_id", "_text", "_at", "_c1", "_c2")
        .join(judged, ["_c1", "_c2"])
        .select("_id", "_text", F.struct((F.col("_at") - F.col("_high")).alias("a"), (F.col("_at") - F.col("_low") + length).alias("b")).alias("_range"))
        .groupBy("_id", "_text")
        .agg(F.collect_set("_range").alias("_ranges"))
    )
    ranges = store.written(ranges, "ranges")
    store.dropped(single, judged)
    return suspects.select("_id", "_text", "text").join(ranges, ["_id", "_text"]), suspects


def _kept(rows: DataFrame, texts: bool) -> DataFrame:
    """(_id, _text, n_removed, n_spans, kept_sha256, kept) of rows with ranges; one row for equal rows."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        for batch in batches:
            removed, spans, digest, kept = [], [], [], []
            for row in range(batch.num_rows):
                raw = batch.column("text")[row].as_buffer().to_pybytes()
                ranges = sorted((r["a"], r["b"]) for r in batch.column("_ranges")[row].as_py())
                left, end, gone, merged = [], 0, 0, 0
                for a, b in ranges:
                    if a > end or not merged:
                        left.append(raw[end:a])
                        merged += 1
                        end = a
                    if b > end:
                        gone += b - end
                        end = b
                left.append(raw[end:])
                rest = b"".join(left)
                removed.append(gone)
                spans.append(merged)
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore") if texts else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": batch.column("_id"),
                    "_text": batch.column("_text"),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(spans, pa.int64()),
                    "kept_sha256": pa.array(digest, pa.string()),
                    "kept": pa.array(kept, pa.string()),
                }
            )

    return rows.mapInArrow(
        made, "_id long, _text long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    rows, suspects = repeated_ranges(docs, length)
    changed = store.written(_kept(rows, texts=False).drop("kept").dropDuplicates(["_id", "_text"]), "changed")
    store.dropped(suspects)
    whole = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("_sha"), *_row_key())
    return base.join(changed, ["_id", "_text"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``; all other columns as they are."""
    rows, suspects = repeated_ranges(docs, length)
    own = store.free_names(docs, "_id", "_text", "kept")
    changed = _kept(rows, texts=True).select("_id", "_text", "kept").dropDuplicates(["_id", "_text"]).toDF(*own)
    changed = store.written(changed, "changed")
    store.dropped(suspects)
    keyed = docs.select("*", *(key.alias(name) for key, name in zip(_row_key(), own))).join(changed, own[:2], "left")
    return keyed.withColumn("text", F.coalesce(own[2], "text")).select(*docs.columns)
