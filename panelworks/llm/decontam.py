"""Benchmark decontamination by a prefix-filtered set join, confirmed word by word.

A window is ``window`` consecutive words of a benchmark item (the whole item if it has fewer). It is
contained in a text only if each of its shingles (runs of up to ``SHINGLE`` words) is. So of the
shingles of a window, ordered from rare to common in the corpus, the first one is a sufficient
prefix for exact containment: a text without it is never looked at. Where a text does have it, its
position fixes the only place where the window can lie; the bounds of the text and the word counts rule
out most places, and the words decide the rest.

The benchmark is read in blocks of a stated size; each block is sent to the executors and all texts
pass by it, so nothing of the corpus is shuffled and no common word gathers rows. Hits of several
blocks are added up per text.

Null and empty texts have no words and are clean. Null, empty and wordless items have no window.
Rows that repeat an id are judged one by one. An item id that comes with several texts counts once
if any of them occurs. A null item id is an item named ``None``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.llm import store
from panelworks.llm import text as T

WINDOW = 13
SHINGLE = 3
#: Bytes of benchmark text in one block; with its index, the size bound of what is broadcast.
BLOCK_BYTES = 8 << 20


@dataclass
class Block:
    """Windows of some items; the arrays are parallel."""

    item: np.ndarray  # number of the item in ``names``
    names: list[str]
    words: list[tuple[bytes, ...]]
    shingles: dict[int, np.ndarray]  # size of shingle -> sorted hashes of all shingles in use
    order: np.ndarray | None = None  # windows by prefix hash
    prefix: np.ndarray | None = None  # their prefix hashes, ascending
    offset: np.ndarray | None = None  # place of the prefix in the window
    size: np.ndarray | None = None  # words of its shingle


def split_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends)]


def windows_of(items: list[tuple[object, str | None]], window: int) -> Block:
    column = pa.array([t for _, t in items], pa.string())
    owner, found, shingles = [], [], {}
    seen = set()
    for lo, hi, data, offsets in T.byte_slices(column):
        lowered = T.LOWER[data]
        starts, ends, bounds = T.words(lowered, offsets, T.ALNUM)
        every = split_words(lowered, starts, ends)
        for i in range(hi - lo):
            own = every[bounds[i] : bounds[i + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1) if own else ():
                words = tuple(own[at : at + size])
                if (lo + i, words) not in seen:
                    seen.add((lo + i, words))
                    owner.append(lo + i)
                    found.append(words)
    del shingles
    return Block(np.array(owner, np.int64), [str(n) for n, _ in items], found, {})


def _window_shingles(words: tuple[bytes, ...]) -> np.ndarray:
    size = min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(words), np.uint8)
    return T.gram_hashes(T.word_hashes(data, ends - lengths, ends), size)


def with_prefixes(block: Block, frequency: dict[int, int]) -> Block:
    """Choose the rarest shingle of each window; ties go to the smaller hash."""
    prefix, offset, size = [], [], []
    for words in block.words:
        h = _window_shingles(words)
        best = min(range(len(h)), key=lambda i: (frequency.get(int(h[i]), 0), int(h[i])))
        prefix.append(int(h[best]))
        offset.append(best)
        size.append(min(SHINGLE, len(words)))
    prefix = np.array(prefix, np.uint64)
    order = np.argsort(prefix, kind="stable")
    block.order, block.prefix = order, prefix[order]
    block.offset, block.size = np.array(offset, np.int64)[order], np.array(size, np.int64)[order]
    return block


def _frequencies(docs: DataFrame, block: Block) -> dict[int, int]:
    """How often each shingle of the block occurs in the corpus; at most one number for each is collected."""
    by_size: dict[int, set[int]] = {}
    for words in block.words:
        by_size.setdefault(min(SHINGLE, len(words)), set()).update(map(int, _window_shingles(words)))
    wanted = {n: np.array(sorted(s), np.uint64) for n, s in by_size.items()}
    # hashes of one block: bounded by its bytes
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        wanted = shared.value
        total = {n: np.zeros(len(h), np.int64) for n, h in wanted.items()}
        filters = {n: _filter(h) for n, h in wanted.items()}
        for batch in batches:
            for _, _, data, offsets in T.byte_slices(batch.column("text")):
                lowered = T.LOWER[data]
                starts, ends, bounds = T.words(lowered, offsets, T.ALNUM)
                h = T.word_hashes(lowered, starts, ends)
                for n, known in wanted.items():
                    _, number = _probe(T.gram_hashes(h, n), known, filters[n])
                    total[n] += np.bincount(number, minlength=len(known))
        for n, known in wanted.items():
            hit = total[n] > 0
            yield pa.RecordBatch.from_pydict(
                {"shingle": pa.array(known[hit].view(np.int64), pa.int64()), "n": pa.array(total[n][hit], pa.int64())}
            )

    counts = docs.select("text").mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {int(np.int64(r["shingle"]).view(np.uint64)): r["n"] for r in counts.collect()}


FILTER_BITS = 20


def _filter(known: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return table


def _probe(h: np.ndarray, known: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``h`` of values in ``known`` (sorted), and their numbers there."""
    maybe = np.flatnonzero(table[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    number = np.searchsorted(known, h[maybe])
    number[number == len(known)] = 0
    hit = known[number] == h[maybe] if len(known) else np.zeros(0, bool)
    return maybe[hit], number[hit]


def _hits(docs: DataFrame, block: Block, keep: list[str]) -> DataFrame:
    """The rows with the positions of hit words and the names of found items."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    fields = {f.name: f for f in docs.schema}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.give_back()
        block = shared.value
        parts = {}
        for n in np.unique(block.size):
            at = np.flatnonzero(block.size == n)
            parts[int(n)] = (at, np.unique(block.prefix[at]), None)
        parts = {n: (at, known, _filter(known)) for n, (at, known, _) in parts.items()}
        length = np.array([len(block.words[w]) for w in block.order], np.int64)
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                lowered = T.LOWER[data]
                starts, ends, bounds = T.words(lowered, offsets, T.ALNUM)
                h = T.word_hashes(lowered, starts, ends)
                cover = np.zeros(len(starts) + 1, np.int64)
                names: dict[int, set[int]] = {}
                for n, (at, known, table) in parts.items():
                    place, _ = _probe(T.gram_hashes(h, n), known, table)
                    own = block.prefix[at]
                    for p in place:
                        text = int(np.searchsorted(bounds, p, "right")) - 1
                        key = T.gram_hashes(h[p : p + n], n)[0]
                        for k in at[np.searchsorted(own, key, "left") : np.searchsorted(own, key, "right")]:
                            first = int(p - block.offset[k])
                            last = first + int(length[k])
                            # the window has to lie in the text
                            if first < bounds[text] or last > bounds[text + 1]:
                                continue
                            words = block.words[block.order[k]]
                            if all(lowered[starts[first + i] : ends[first + i]].tobytes() == w for i, w in enumerate(words)):
                                cover[first] += 1
                                cover[last] -= 1
                                names.setdefault(text, set()).add(int(block.item[block.order[k]]))
                hit = np.cumsum(cover[:-1]) > 0
                which = [np.flatnonzero(hit[a:b]).astype(np.int32) if i in names else None for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(lo, hi - lo) for c in keep],
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(which, pa.list_(pa.int32())),
                        pa.array([sorted({block.names[k] for k in names[i]}) if i in names else None for i in range(hi - lo)], pa.list_(pa.string())),
                    ],
                    names=[*keep, "n_words", "_hit", "_items"],
                )

    from pyspark.sql import types as S

    schema = S.StructType(
        [
            *[fields[c] for c in keep],
            S.StructField("n_words", S.LongType()),
            S.StructField("_hit", S.ArrayType(S.IntegerType())),
            S.StructField("_items", S.ArrayType(S.StringType())),
        ]
    )
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(found, schema)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """Items in runs of at most ``block_bytes``, taken from the table one run at a time."""
    held, size = [], 0
    for r in benchmark.select("item_id", "text").filter("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        own = len(r["text"].encode())
        if held and size + own > block_bytes:
            yield held
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += own
    if held:
        yield held


def _digest(hits, items, n_words="n_words"):
    hit = F.size(F.coalesce(hits, F.array().cast("array<int>"))).cast("long")
    named = F.sort_array(F.coalesce(items, F.array().cast("array<string>")))
    return [
        hit.alias("n_hit"),
        F.size(named).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 20 >= F.col(n_words))).alias("contaminated"),
    ]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the carried columns (doc_id), n_words, n_hit, n_items, items_sha256, contaminated.

    A row is contaminated if words of benchmark windows make at least a twentieth of its words.
    """
    carry = ["doc_id"] if carry is None else carry
    blocks = [b for b in (windows_of(items, window) for items in _blocks(benchmark, block_bytes)) if b.words]
    if not blocks:
        blocks = [windows_of([], window)]
    if len(blocks) == 1:
        found = _hits(docs, with_prefixes(blocks[0], _frequencies(docs, blocks[0])), carry)
        return found.select(*carry, "n_words", *_digest(F.col("_hit"), F.col("_items")))
    # several blocks: a row is known by its number in the stored corpus
    rows = store.written(docs.select(*dict.fromkeys([*carry, "text"])).withColumn("_row", F.monotonically_increasing_id()), "rows")
    total = None
    for block in blocks:
        part = _hits(rows, with_prefixes(block, _frequencies(rows, block)), ["_row"]).filter("_hit IS NOT NULL")
        total = part if total is None else total.union(part)
    merged = (
        total.groupBy("_row")
        .agg(F.collect_list("_hit").alias("_hit"), F.collect_list("_items").alias("_items"))
        .select("_row", F.array_distinct(F.flatten("_hit")).alias("_hit"), F.array_distinct(F.flatten("_items")).alias("_items"))
    )
    merged = store.written(merged, "hits")
    sized = _hits(rows, with_prefixes(windows_of([], window), {}), [*carry, "_row"]).drop("_hit", "_items")
    return sized.join(merged, "_row", "left").select(*carry, "n_words", *_digest(F.col("_hit"), F.col("_items")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    taken = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated", "_hit", "_items", "_row"}
    names = {c: f"_own_{i}" if c in taken else c for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    judged = contamination(plain, benchmark, window, carry=list(names.values()))
    return judged.filter(~F.col("contaminated")).select(*names.values()).toDF(*docs.columns)
