"""Near-duplicate texts by circulant MinHash, banding, and Jaccard on the full sets.

A text is the set of its distinct runs of ``shingle`` words; a shorter text is one run. Two texts
are linked if the Jaccard similarity of their sets is at least ``percent`` / 100. The result gives
each text the smallest id it can reach over links.

Circulant MinHash draws two permutations only. The first one scatters the shingles over D places.
Coordinate k of the signature is the smallest value of the second one, shifted by k places, over the
places of the set. The values of all shifts for one place are neighbours in memory, so a signature
is the column-wise minimum of slices.

Steps, all on Spark:

1. one pass over the texts gives set size, set fingerprint and band hashes; texts with the same set
   become one class, known by a hash of that set, whatever their ids. One text of each class that shares a
   band is stored, with one byte of each coordinate of its signature;
2. classes that share a band are candidates. Each is first compared with one class of the band
   only (a star, never all pairs), the smallest one, and the links found give components.
   In bands that still hold several components, the members outside the largest one are compared
   with one member of it, again another one in each band;
3. what is still apart after that is compared across the components of its bands, in blocks of
   bounded size; the largest component meets the others only, never itself;
4. every candidate that sizes and signature bytes leave open is confirmed on the full sets, made
   again from the whole texts;
5. smallest ids spread over the links until nothing changes.

Null, empty and blank texts have an empty set, are linked with nothing and kept. Every row is
returned. Rows of one id are one document; if their texts differ, it reaches the copies and near copies of
each of them. Rows without an id have no component and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.llm import store
from panelworks.llm import text as T

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
#: Places of the permutations.
PLACES = 1 << 20
#: Members of a band in one block; two blocks meet in one task at a time.
BLOCK = 1024
#: Coordinates of which one byte is kept to estimate a similarity; the first ones make the bands.
MARKS = 256
#: Share of equal bytes below which a pair cannot reach the threshold. At a similarity of 0.75 the
#: share has mean 0.75 and deviation 0.027, so 0.60 is more than five of them off.
LEAST_SHARE = 0.60
#: Rounds of stars before components are compared with each other.
STARS = 2


@lru_cache(maxsize=2)
def permutation(places: int, reach: int) -> np.ndarray:
    """The circulant permutation, continued by its first ``reach`` values."""
    order = np.random.default_rng(7).permutation(places).astype(np.uint32)
    return np.concatenate([order, order[:reach]])


def scattered(h: np.ndarray, places: int) -> np.ndarray:
    """The first permutation: where a shingle lies among ``places``."""
    return (T.mixed(h ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - places.bit_length() + 1)).astype(np.int64)


def signature(h: np.ndarray, coordinates: int, places: int = PLACES) -> np.ndarray:
    """Circulant MinHash of a set of shingle hashes."""
    slices = np.lib.stride_tricks.sliding_window_view(permutation(places, coordinates), coordinates)
    at = scattered(h, places)
    out = slices[at[:512]].min(axis=0)
    for first in range(512, len(at), 512):
        np.minimum(out, slices[at[first : first + 512]].min(axis=0), out=out)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash of each run of ``rows`` coordinates; the band number is part of it."""
    grid = sig.reshape(bands, rows).astype(np.uint64)
    factors = T.powers(T.BASE, rows + 2)[1 : rows + 1]
    return T.mixed((grid * factors).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lowered = T.LOWER[data]
    starts, ends, bounds = T.words(lowered, offsets, T.NOT_SPACE)
    h = T.sure_word_hashes(lowered, starts, ends)
    grams = T.gram_hashes(h, shingle)
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= shingle:
            yield T.distinct(grams[a : b - shingle + 1])
        elif b > a:
            yield T.gram_hashes(h[a:b], int(b - a))
        else:
            yield h[:0]


def _features(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                sizes, first, second, keys = [], [], [], []
                for s in shingle_sets(data, offsets, shingle):
                    sizes.append(len(s))
                    first.append(int(T.mixed(s).sum(dtype=np.uint64).view(np.int64)))
                    second.append(int(T.mixed(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64).view(np.int64)))
                    if len(s):
                        keys.append(band_hashes(signature(s, bands * rows), bands, rows).view(np.int64))
                    else:
                        keys.append(None)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[lo:hi],
                        "_order": batch.column("_order")[lo:hi],
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "_f1": pa.array(first, pa.int64()),
                        "_f2": pa.array(second, pa.int64()),
                        "_bands": pa.array(keys, pa.list_(pa.int64())),
                    }
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("_order")).mapInArrow(
        made, "doc_id long, _order long, n_shingles long, _f1 long, _f2 long, _bands array<long>"
    )


def _marked(texts: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(node, n_shingles, _mark, _bands) of the classes that share a band, from their texts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                sizes, marks, keys = [], [], []
                for s in shingle_sets(data, offsets, shingle):
                    sig = signature(s, max(MARKS, bands * rows))
                    sizes.append(len(s))
                    marks.append(sig.astype(np.uint8).tobytes())
                    keys.append(band_hashes(sig[: bands * rows], bands, rows).view(np.int64))
                arrays = [batch.column("node")[lo:hi], pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "n_shingles", "_mark", "_bands"])

    return texts.mapInArrow(made, "node long, n_shingles long, _mark binary, _bands array<long>")


def _close(pairs: DataFrame, percent: int, least_share: float) -> DataFrame:
    """Pairs (a, b, mark_a, mark_b) whose signature bytes agree often enough: (a, b)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("mark_a", "mark_b"))
            keep = pa.array((x == y).mean(axis=1) >= least_share)
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(keep), "b": batch.column("b").filter(keep)})

    return pairs.mapInArrow(kept, "a long, b long")


def _sized(n_a: str, n_b: str, percent: int):
    """Sizes that allow the similarity: the smaller set is at least ``percent`` of the larger."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: (a, b). ``docs`` has one text for each class."""
    left = pairs.join(docs.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    right = docs.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = left.join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[dict[int, np.ndarray]] = [{}, {}]
            names = ("a", "b")
            for side, name in enumerate(names):
                ids = batch.column(name).to_pylist()
                column = batch.column(f"text_{name}")
                seen: dict[int, int] = {}
                for row, i in enumerate(ids):
                    seen.setdefault(i, row)
                own = column.take(pa.array(list(seen.values()), pa.int64()))
                keys = list(seen)
                for lo, _, data, offsets in T.byte_slices(own):
                    for k, s in enumerate(shingle_sets(data, offsets, shingle)):
                        sets[side][keys[lo + k]] = s
            a, b = (batch.column(n).to_pylist() for n in names)
            keep = []
            for i, j in zip(a, b):
                x, y = sets[0][i], sets[1][j]
                common = _common(x, y)
                keep.append(common * 100 >= percent * (len(x) + len(y) - common) and common > 0)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(keep), "b": batch.column("b").filter(keep)})

    return store.written(both.mapInArrow(linked, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of ``links`` (a, b) can reach.

    Every round gives each node the smallest label among its neighbours, then the label of that
    label, and puts the links between labels in place of the links between nodes. Links inside a
    label vanish, so the rounds grow with the logarithm of a component's width and shrink fast.
    """
    links = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = store.written(links.distinct(), "links")
    known = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = store.written(known.withColumn("component", F.col("node")), "components")
    while links.limit(1).count():
        ends = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        least = ends.groupBy("e.a").agg(F.min("e.b").alias("_near"))
        least = store.written(least.select(F.col("a").alias("_of"), F.least("a", "_near").alias("_to")), "labels")
        after = least.select(F.col("_of").alias("_to"), F.col("_to").alias("_then"))
        labels = store.written(least.join(after, "_to").select("_of", F.col("_then").alias("_label")), "labels")
        first = links.join(labels.withColumnRenamed("_of", "a"), "a").select("b", F.col("_label").alias("_a"))
        both = first.join(labels.withColumnRenamed("_of", "b"), "b").filter(F.col("_a") != F.col("_label"))
        next_links = store.written(
            both.select(F.least("_a", "_label").alias("a"), F.greatest("_a", "_label").alias("b")).distinct(), "links"
        )
        moved = known.join(labels.withColumnRenamed("_of", "component"), "component", "left")
        next_known = store.written(moved.select("node", F.coalesce("_label", "component").alias("component")), "components")
        store.dropped(links, known, least, labels)
        links, known = next_links, next_known
    store.dropped(links)
    return known


def _near(pairs: DataFrame, sizes: DataFrame, percent: int, least_share: float) -> DataFrame:
    """Of the candidates (a, b), those that sizes and signature bytes leave open; stored."""
    left = pairs.join(sizes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("_mark").alias("mark_a")).hint("merge"), "a")
    both = left.join(sizes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("_mark").alias("mark_b")).hint("merge"), "b")
    fit = both.filter(_sized("n_a", "n_b", percent)).select("a", "b", "mark_a", "mark_b")
    return store.written(_close(fit, percent, least_share), "near")


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of each member and the hub of its band; stored."""
    pair = [F.least("_hub", "node").alias("a"), F.greatest("_hub", "node").alias("b")]
    return store.written(rows.filter(F.col("_hub") != F.col("node")).select(*pair).distinct(), "star")


def _named(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members of the bands that still hold several components, with the largest one of the band; stored.

    (_band, node, component, _base, _bases, _others): the last two are numbers of members.
    """
    named = members.select("_band", "node").join(known, "node", "left")
    named = store.written(named.withColumn("component", F.coalesce("component", "node")), "band-members")
    parts = named.groupBy("_band", "component").agg(F.count(F.lit(1)).alias("_rows"))
    bands = (
        parts.groupBy("_band")
        .agg(F.max(F.struct("_rows", "component")).alias("_top"), F.sum("_rows").alias("_all"), F.count(F.lit(1)).alias("_parts"))
        .filter(F.col("_parts") > 1)
        .select(
            "_band",
            F.col("_top.component").alias("_base"),
            F.col("_top._rows").alias("_bases"),
            (F.col("_all") - F.col("_top._rows")).alias("_others"),
        )
    )
    bands = store.written(bands, "open-bands")
    found = store.written(named.join(bands, "_band"), "open-members")
    store.dropped(named, bands)
    return found


def _second_star(named: DataFrame) -> DataFrame:
    """Candidates: members outside the largest component of a band, with one member of it."""
    base = named.filter(F.col("component") == F.col("_base"))
    hubs = base.groupBy("_band").agg(F.min_by("node", F.xxhash64("node", "_band", F.lit(2))).alias("_hub"))
    hubs = store.written(hubs, "hubs")
    found = _pairs(named.filter(F.col("component") != F.col("_base")).join(hubs, "_band"))
    store.dropped(hubs)
    return found


def _across(named: DataFrame, heads: DataFrame, docs: DataFrame, shingle: int, percent: int, least_share: float, block: int) -> DataFrame:
    """Links (a, b) between members of a band that lie in different components; stored.

    Members are numbered blocks of at most about ``block`` rows. Blocks of the largest component
    of a band meet the blocks of the others; blocks of others also meet one another. The signature bytes tell which
    members of a meeting have a candidate; only those meet once more, with their full sets. A pair
    is looked at in the first band that it shares, and only links leave a task.
    """
    key = ["_band", "_x", "_y"]
    cut = {c: F.ceil(F.col(c) / block).cast("int") for c in ("_bases", "_others")}
    is_base = F.col("component") == F.col("_base")
    slot = F.pmod(F.xxhash64("node"), F.when(is_base, F.col("_bases")).otherwise(F.col("_others"))).cast("int")
    rows = named.withColumns(cut).withColumn("_slot", slot)
    # a base block meets each block of others; a block of others meets itself, the later and the earlier ones
    others = F.sequence(F.lit(0), F.col("_others") - 1)
    to_bases = F.transform(F.sequence(F.lit(0), F.col("_bases") - 1), lambda j: F.struct(F.col("_slot").alias("x"), (-j - 1).alias("y")))
    to_others = F.transform(others, lambda j: F.struct(F.least("_slot", j).alias("x"), F.greatest("_slot", j).alias("y")))
    of_base = F.transform(others, lambda j: F.struct(j.alias("x"), (-F.col("_slot") - 1).alias("y")))
    rows = rows.withColumn("_meet", F.explode(F.when(is_base, of_base).otherwise(F.concat(to_bases, to_others))))
    meeting = rows.select("_band", F.col("_meet.x").alias("_x"), F.col("_meet.y").alias("_y"), "node", "component")
    fields = ["n_shingles", "_mark", "_bands"]
    dealt = meeting.join(heads.select("node", *fields), "node").repartition(*key).sortWithinPartitions(*key, "node")
    dealt = dealt.select(*key, "node", "component", *fields)
    involved = store.written(
        dealt.mapInArrow(_meetings(key, percent, least_share, False), "_band long, _x int, _y int, node long, component long"), "involved"
    )
    sets = store.written(_sets(docs, involved.select("node").distinct(), shingle), "sets")
    again = (
        involved.join(heads.select("node", *fields), "node")
        .join(sets, "node")
        .repartition(*key)
        .sortWithinPartitions(*key, "node")
        .select(*key, "node", "component", *fields, "_set")
    )
    links = store.written(again.mapInArrow(_meetings(key, percent, least_share, True), "a long, b long"), "across")
    store.dropped(involved, sets)
    return links


def _sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(node, _set): the full shingle sets of the classes in ``ids``."""
    ids = store.written(ids, "set-ids")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in T.byte_slices(batch.column("text")):
                found = [s.tobytes() for s in shingle_sets(data, offsets, shingle)]
                yield pa.RecordBatch.from_pydict({"node": batch.column("node")[lo:hi], "_set": pa.array(found, pa.binary())})

    return docs.join(ids, "node", "left_semi").mapInArrow(made, "node long, _set binary")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _meetings(key: list[str], percent: int, least_share: float, with_sets: bool):
    """Compare the rows of each key, which come sorted; a key has two blocks at most.

    Without sets the rows that have a candidate come out, with sets the links.
    """

    def candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        k = np.stack([table.column(c).to_numpy() for c in key])
        comp, n = (table.column(c).to_numpy() for c in ("component", "n_shingles"))
        marks = np.frombuffer(b"".join(table.column("_mark").to_pylist()), np.uint8).reshape(len(n), -1)
        bands = table.column("_bands").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        first_marks = np.ascontiguousarray(marks[:, : marks.shape[1] // 4])
        # twice the deviation of all bytes
        quarter_share = percent / 100 - 2 * (percent / 100 - least_share)
        starts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1])
        lengths = np.diff(np.append(starts, len(n)))
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in np.unique(lengths[lengths > 1]):
            i, j = np.triu_indices(size, 1)
            at = starts[lengths == size]
            groups = max(1, (1 << 16) // len(i))  # so many groups of this size at a time
            for some in range(0, len(at), groups):
                x, y = ((at[some : some + groups, None] + m[None, :]).ravel() for m in (i, j))
                keep = (comp[x] != comp[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent)
                x, y = x[keep], y[keep]
                for first in range(0, len(x), 1 << 13):
                    u, v = x[first : first + (1 << 13)], y[first : first + (1 << 13)]
                    # a quarter of the bytes rules out most pairs
                    near = (first_marks[u] == first_marks[v]).mean(axis=1) >= quarter_share
                    u, v = u[near], v[near]
                    near = (marks[u] == marks[v]).mean(axis=1) >= least_share
                    u, v = u[near], v[near]
                    # only in the first band that both share
                    shared = bands[u] == bands[v]
                    here = bands[u, shared.argmax(axis=1)] == k[0][u]
                    lefts.append(u[here])
                    rights.append(v[here])
        return np.concatenate(lefts), np.concatenate(rights)

    def compared(table: pa.Table) -> pa.RecordBatch:
        x, y = candidates(table)
        ids = table.column("node").to_numpy()
        if not with_sets:
            rows = table.select([*key, "node", "component"]).take(pa.array(T.distinct(np.concatenate([x, y]))))
            return rows.combine_chunks().to_batches()[0] if rows.num_rows else pa.RecordBatch.from_pylist([], rows.schema)
        sets = {}
        column = table.column("_set")
        linked = []
        for i, j in zip(x.tolist(), y.tolist()):
            for m in (i, j):
                if m not in sets:
                    sets[m] = np.frombuffer(column[m].as_py(), np.uint64)
            common = _common(sets[i], sets[j])
            linked.append(common * 100 >= percent * (len(sets[i]) + len(sets[j]) - common))
        keep = np.array(linked, bool)
        return pa.RecordBatch.from_arrays([pa.array(ids[x[keep]], pa.int64()), pa.array(ids[y[keep]], pa.int64())], names=["a", "b"])

    def last_start(batch: pa.RecordBatch) -> int:
        k = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in key])
        differs = np.flatnonzero((k != k[:, -1:]).any(axis=0))
        return int(differs[-1]) + 1 if len(differs) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and any(held[-1].column(c)[held[-1].num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in key):
                yield compared(pa.Table.from_batches(held))
                held = []
            at = last_start(batch)
            if at:
                yield compared(pa.Table.from_batches([*held, batch.slice(0, at)]))
                held = []
            held.append(batch.slice(at))
        if held:
            yield compared(pa.Table.from_batches(held))

    return run


def _linked(
    docs: DataFrame, shingle: int, percent: int, bands: int, rows: int, block: int, least_share: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs`` with their class, which is null without an id or a shingle; the first row of each class,
    by id and text hash; and the links (a, b) between classes."""
    features = _features(docs, shingle, bands, rows)
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.xxhash64("n_shingles", "_f1", "_f2"))
    seen = store.written(features.withColumn("_class", own).drop("_f1", "_f2"), "signatures")
    head = F.struct("doc_id", "_order", "_bands")
    heads = seen.filter("_class IS NOT NULL").groupBy(F.col("_class").alias("node")).agg(F.min_by(head, F.struct("doc_id", "_order")).alias("_head"))
    heads = store.written(heads.select("node", "_head.*"), "heads")
    in_bands = heads.select("node", F.explode("_bands").alias("_band"))
    # classes are hashes, so the smallest one is any of them; the same one in all bands of a group makes few pairs
    hubs = in_bands.groupBy("_band").agg(F.min("node").alias("_hub"), F.max("node").alias("_last"))
    hubs = store.written(hubs.filter("_hub < _last").drop("_last"), "hubs")
    members = store.written(in_bands.join(hubs.hint("merge"), "_band").select("_band", "node", "_hub"), "members")
    # the texts that may have to be read again, one for each class that shares a band: that of its first row
    shared = heads.select("node", "doc_id", "_order").join(members.select("node").distinct(), "node", "left_semi")
    shared = store.written(shared, "shared-ids")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_order")).join(shared.hint("merge"), ["doc_id", "_order"])
    texts = store.written(texts.groupBy("doc_id", "_order", "node").agg(F.min("text").alias("text")).select("node", "text"), "shared-texts")
    sizes = store.written(_marked(texts, shingle, bands, rows), "marks")

    tried = _near(_pairs(members), sizes, percent, least_share)
    links = _confirmed(tried, texts, shingle, percent)
    named = _named(members, components(links))
    for _ in range(STARS - 1):
        more = _near(_second_star(named), sizes, percent, least_share)
        more = store.written(more.join(tried, ["a", "b"], "left_anti"), "star")
        links = store.written(links.union(_confirmed(more, texts, shingle, percent)), "links")
        tried = store.written(tried.union(more), "tried")
        named = _named(members, components(links))
    links = store.written(links.union(_across(named, sizes, texts, shingle, percent, least_share, block)), "links")
    store.dropped(hubs, members, named, tried, shared, texts, sizes)
    return seen, heads, links


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    seen, heads, links = _linked(docs, shingle, percent, bands, rows, block, least_share)
    class_of = store.written(seen.filter("_class IS NOT NULL").select("doc_id", "_class").distinct(), "class-of")
    # rows of one id are one document: their classes are linked
    several = class_of.groupBy("doc_id").agg(F.min("_class").alias("a"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    same = class_of.join(store.written(several, "several"), "doc_id").filter("_class <> a").select("a", F.col("_class").alias("b"))
    named = heads.select("node", "doc_id").join(components(links.union(same)), "node", "left")
    named = store.written(named.withColumn("component", F.coalesce("component", "node")), "named")
    least = store.written(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    of_class = store.written(named.join(least, "component").select(F.col("node").alias("_class"), "component_id"), "of-class")
    reach = class_of.join(of_class, "_class").filter("component_id <> doc_id").select("doc_id", "component_id").distinct()
    reach = store.written(reach, "components")
    store.dropped(heads, links, class_of, named, least, of_class)
    component = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return (
        seen.select("doc_id", "n_shingles")
        .join(reach, "doc_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; a document is one (doc_id, text).

    Of the texts of a component the one of the smallest id stays, of several of them that with the smallest hash. Texts
    that are linked with nothing stay whatever their id; rows that repeat an id and a text count once.
    """
    seen, heads, links = _linked(docs, SHINGLE, PERCENT, BANDS, ROWS, BLOCK, LEAST_SHARE)
    named = heads.select("node", "doc_id", "_order").join(components(links), "node", "left")
    named = store.written(named.withColumn("component", F.coalesce("component", "node")), "named")
    first = store.written(named.groupBy("component").agg(F.min(F.struct("doc_id", "_order")).alias("_first")), "first")
    of_class = store.written(named.join(first, "component").select(F.col("node").alias("_class"), F.col("_first.doc_id").alias("_id"), F.col("_first._order").alias("_least")), "of-class")
    texts = store.written(seen.filter("_class IS NOT NULL").select("doc_id", "_order", "_class").distinct(), "class-of")
    gone = texts.join(of_class, "_class").filter("doc_id <> _id OR _order <> _least")
    own_id, own_text = store.free_names(docs, "_rid", "_text")
    gone = store.written(gone.select(F.col("doc_id").alias(own_id), F.col("_order").alias(own_text)), "copies")
    repeated = seen.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(own_id), F.col("_order").alias(own_text)).count()
    repeated = store.written(repeated.filter("count > 1").select(own_id, own_text), "repeated-rows")
    store.dropped(seen, heads, links, named, first, of_class, texts)
    keyed = docs.select("*", F.col("doc_id").alias(own_id), F.xxhash64("text").alias(own_text))
    left = keyed.join(gone, [own_id, own_text], "left_anti")
    if not repeated.limit(1).count():
        return left.select(*docs.columns)
    single = left.join(repeated, [own_id, own_text], "left_anti")
    several = left.join(repeated, [own_id, own_text], "left_semi").dropDuplicates([own_id, own_text])
    return single.union(several).select(*docs.columns)
