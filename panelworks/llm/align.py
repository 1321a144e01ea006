"""Alignment of two tokenizers over the same bytes, by lockstep merging of their token ends.

Both tokenizers see a space and the text. Byte offsets where a token of A and a token of B end cut the
tokens into groups; within a group every A token is linked with every B token. The count of a pair of ids is the
number of documents that hold it linked.

1. Texts are encoded in slices, each distinct word once in a worker. The bytes of the tokens are compared with those of the
   text; texts whose bytes differ, and null and empty texts, have no tokens.
2. One NumPy state vector holds a pointer into A and one into B for every lane, a lane being a document or, in a long one, a part
   of it that begins where both end a token. Each step moves the pointer whose token ends
   first, or both; then a group is cut. Finished lanes are taken out of the vector.
3. A slice becomes one stored row: its documents and, for each pair of ids, who holds it and how often. Only the
   pairs of a slice, not its links, are counted over the corpus, joined with the counts, and brought back to the slice.

A row is a document, also if it repeats an id; other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import encode, store
from panelworks.llm import text as T
from panelworks.llm.encode import runs

#: Bytes of text in one slice; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Words kept by each of the two encoders of a worker.
MOST_WORDS = 150_000
#: A tokens after which a lane looks for a place to end, and how far it looks.
LANE, REACH = 256, 64
#: Links of one group that are listed one by one; a larger group is counted by its distinct ids.
LISTED = 1 << 12


# ---- tokens --------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The byte of each letter in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class Pieces(encode.Encoder):
    """Ids of a sentence-piece model for texts that begin with a space, each distinct word encoded once.

    No piece holds a blank after another letter, so nothing is merged across the beginning of a
    run of blanks, and words cut there are encoded alone. The model puts a blank before what it is given, in place of
    the first one of the word.
    """

    kind = "piece"
    blanks = np.array([0x20, 0x2581], np.uint32)

    def __init__(self, content: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            self.kind = None
        self.blank = np.array([self.model.piece_to_id("▁")], np.uint32)
        self.special = []
        self.words = encode.Words()
        self.most_words = MOST_WORDS

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]

    def _each(self, words: list[str]) -> list[np.ndarray]:
        return [self.blank if len(w) == 1 else ids for w, ids in zip(words, self._whole(words))]

    def _cut(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        blank = np.isin(codes, self.blanks)
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[begins] = True
        starts = np.flatnonzero(start)
        return starts, np.append(starts[1:], len(codes)), np.searchsorted(starts, offsets)


@dataclass
class Side:
    """An encoder, and the bytes of each of its tokens as a run of ``pool``."""

    encoder: encode.Encoder
    start: np.ndarray
    length: np.ndarray
    pool: np.ndarray

    @classmethod
    def of(cls, encoder: encode.Encoder, tokens: list[bytes]) -> Side:
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return cls(encoder, np.cumsum(length) - length, length, np.frombuffer(b"".join(tokens), np.uint8))


@lru_cache(maxsize=4)
def byte_level(content: str) -> Side:
    own = encode.Encoder(content, plain_special=True)
    own.most_words = MOST_WORDS
    letters = byte_letters()
    tokens = [b""] * own.tokenizer.get_vocab_size()
    for token, i in own.tokenizer.get_vocab(with_added_tokens=False).items():
        tokens[i] = bytes(letters[c] for c in token)
    return Side.of(own, tokens)


@lru_cache(maxsize=4)
def pieces(content: bytes) -> Side:
    own = Pieces(content)
    tokens = []
    for i in range(own.model.get_piece_size()):
        piece = own.model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if own.model.is_byte(i) else piece.replace("▁", " ").encode())
    return Side.of(own, tokens)


# ---- lockstep merging ----------------------------------------------------------------------


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin: (A token, B token). ``first`` are the first A tokens of the documents, and the end.

    A document begins a lane. A longer one begins another at about every ``LANE`` tokens, at the first token after a
    place where A and B both end one.
    """
    aim = np.arange(LANE, max(len(ends_a), 1), LANE)
    last = first[np.searchsorted(first, aim, "right")] - 1 if len(aim) else aim  # last token of the document
    inner = []
    for step in range(REACH):
        aim, last = aim[aim + step < last], last[aim + step < last]
        if not len(aim):
            break
        end = ends_a[aim + step]
        common = ends_b[np.minimum(np.searchsorted(ends_b, end), len(ends_b) - 1)] == end
        inner.append(aim[common] + step + 1)
        aim, last = aim[~common], last[~common]
    a = T.distinct(np.concatenate([first, *inner]).astype(np.int64))
    before = np.concatenate([[0], ends_a])[a]  # bytes before the lane
    return a, np.searchsorted(ends_b, before, "right")


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A token and first B token of every group, in order, and the numbers of tokens at the end.

    ``ends_a`` and ``ends_b`` are the ascending byte offsets where tokens end; documents follow one another.
    """
    begin_a, begin_b = lanes(ends_a, ends_b, first)
    stop = begin_a[1:]
    i, j = begin_a[:-1].copy(), begin_b[:-1].copy()
    live = i < stop
    i, j, stop = i[live], j[live], stop[live]
    cuts_a, cuts_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(i):
        a, b = ends_a[i], ends_b[j]
        i = i + (a <= b)
        j = j + (b <= a)
        cut = a == b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    group_a, group_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    by = np.argsort(group_a)
    zero = np.zeros(1, np.int64)
    return np.concatenate([zero, group_a[by]]), np.concatenate([zero, group_b[by]])


def pair_counts(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, doc: np.ndarray, docs: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document, links) of all pairs of ids, ascending; a pair is A id * width + B id.

    ``doc`` is the document of each group.
    """
    n_a, n_b = np.diff(group_a), np.diff(group_b)
    few = np.flatnonzero(n_a * n_b <= LISTED)
    size = (n_a * n_b)[few]
    at = runs(np.zeros(len(few), np.int64), size)
    of = np.repeat(few, size)
    keys = [(a[group_a[of] + at // n_b[of]].astype(np.int64) * width + b[group_b[of] + at % n_b[of]]) * docs + doc[of]]
    times = [np.ones(len(at), np.int64)]
    for g in np.flatnonzero(n_a * n_b > LISTED):
        (ids_a, of_a), (ids_b, of_b) = (np.unique(x[s[g] : s[g + 1]], return_counts=True) for x, s in ((a, group_a), (b, group_b)))
        keys.append(((ids_a[:, None].astype(np.int64) * width + ids_b[None, :]) * docs + doc[g]).ravel())
        times.append((of_a[:, None] * of_b[None, :]).ravel())
    key, times = np.concatenate(keys), np.concatenate(times)
    by = np.argsort(key, kind="stable")
    key = key[by]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(times[by], new) if len(new) else new
    key = key[new]
    return key // docs, key % docs, total


def written_groups(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;``, as bytes, and where each group begins."""
    n_a, n_b = np.diff(group_a), np.diff(group_b)
    total = len(a) + len(b)
    ids, mark = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8)
    ids[np.arange(len(a)) + np.repeat(group_b[:-1], n_a)] = a
    ids[np.arange(len(b)) + np.repeat(group_a[1:], n_b)] = b
    mark[group_a[1:] + group_b[:-1] - 1] = ord("|")
    mark[group_a[1:] + group_b[1:] - 1] = ord(";")
    digits = np.ones(total, np.int64)
    for power in range(1, 10):
        digits += ids >= 10**power
    start = np.cumsum(digits + 1) - digits - 1
    out = np.zeros(int((digits + 1).sum()), np.uint8)
    for k in range(int(digits.max(initial=0))):
        some = np.flatnonzero(digits > k)
        out[start[some] + digits[some] - 1 - k] = ord("0") + ids[some] // 10**k % 10
    out[start + digits] = mark
    return out, np.append(start, len(out))[group_a + group_b]


@dataclass
class Aligned:
    """The tokens and groups of the texts of a slice; ``doc_a``, ``doc_b`` and ``doc_g`` are where each text begins."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    doc_g: np.ndarray


def _as_read(side: Side, texts: list[str], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, where each text begins, and which texts have the bytes of their tokens."""
    ids, cut = side.encoder.encode(texts)
    length = side.length[ids]
    end = np.concatenate([[0], np.cumsum(length)])
    size = end[cut[1:]] - end[cut[:-1]]
    good = size == np.diff(offsets)
    for k in np.flatnonzero(good):
        own = ids[cut[k] : cut[k + 1]]
        read = side.pool[runs(side.start[own], side.length[own])]
        good[k] = np.array_equal(read, data[offsets[k] : offsets[k + 1]])
    return ids, cut, good


def aligned(texts: list[str | None], left: Side, right: Side) -> Aligned:
    """Both tokenizers over a space and each text, merged in lockstep."""
    whole = [" " + t if t else "" for t in texts]
    raw = [t.encode() for t in whole]
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    a, cut_a, good_a = _as_read(left, whole, data, offsets)
    b, cut_b, good_b = _as_read(right, whole, data, offsets)
    good = good_a & good_b
    n_a, n_b = np.where(good, np.diff(cut_a), 0), np.where(good, np.diff(cut_b), 0)
    a, b = a[runs(cut_a[:-1], n_a)], b[runs(cut_b[:-1], n_b)]
    doc_a, doc_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    group_a, group_b = lockstep(np.cumsum(left.length[a]), np.cumsum(right.length[b]), doc_a)
    return Aligned(a, b, doc_a, doc_b, group_a, group_b, np.searchsorted(group_a, doc_a))


# ---- Spark ---------------------------------------------------------------------------------

DOCUMENT = "struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>"
#: One slice: its documents, and for each pair of ids the run of ``who`` (documents) and ``times`` (links) that is its own.
SLICE = f"slice long, documents array<{DOCUMENT}>, pairs binary, cuts binary, who binary, times binary"


def _slices(docs: DataFrame, left: str, right: bytes) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(left), pieces(right)
        width = len(two.length)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, _, _ in T.byte_slices(batch.column("text"), SLICE_BYTES):
                found = aligned(batch.column("text").slice(lo, hi - lo).to_pylist(), one, two)
                count = hi - lo
                doc = np.repeat(np.arange(count), np.diff(found.doc_g))
                links = np.bincount(doc, np.diff(found.group_a) * np.diff(found.group_b), count).astype(np.int64)
                text, place = written_groups(found.a, found.b, found.group_a, found.group_b)
                digests = []
                for x, y in zip(place[found.doc_g[:-1]], place[found.doc_g[1:]]):
                    digests.append(hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "")
                pair, who, times = pair_counts(found.a, found.b, found.group_a, found.group_b, doc, count, width)
                new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
                columns = [batch.column("doc_id").slice(lo, count), *(pa.array(c, pa.int64()) for c in (np.diff(found.doc_a), np.diff(found.doc_b), np.diff(found.doc_g), links)), pa.array(digests)]
                documents = pa.StructArray.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
                packed = [pair[new].astype("<i8"), np.append(new, len(pair)).astype("<i4"), who.astype("<u4"), times.astype("<i8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), documents), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                    names=["slice", "documents", "pairs", "cuts", "who", "times"],
                )
                number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, SLICE)


def _pairs(slices: DataFrame) -> DataFrame:
    """(slice, pair, holders) of every pair of ids in every slice."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pairs, cuts in zip(*(batch.column(c).to_pylist() for c in ("slice", "pairs", "cuts"))):
                pair = np.frombuffer(pairs, "<i8")
                for first in range(0, len(pair), 1 << 16):
                    some = pair[first : first + (1 << 16)]
                    holders = np.diff(np.frombuffer(cuts, "<i4")[first : first + len(some) + 1])
                    yield pa.RecordBatch.from_pydict({"slice": np.full(len(some), number), "pair": some, "holders": holders.astype(np.int64)})

    return slices.select("slice", "pairs", "cuts").mapInArrow(made, "slice long, pair long, holders long")


def _counts(pairs: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many documents hold a pair linked, and whether no pair of its A id has more.

    An A id has at most as many pairs as there are B ids.
    """
    counts = pairs.groupBy("pair").agg(F.sum("holders").alias("count")).withColumn("_a", F.expr(f"pair div {width}"))
    most = F.max("count").over(Window.partitionBy("_a"))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def link_counts(docs: DataFrame, left: str, right: bytes) -> DataFrame:
    """(a, b, count, best) of every pair of ids that is linked in a document."""
    width = len(pieces(right).length)
    counts = _counts(_pairs(store.written(_slices(docs, left, right), "slices")), width)
    return counts.select(F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "count", "best")


def groups(docs: DataFrame, left: str, right: bytes) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_cuts, b_cuts) of every row of ``docs``: the ids, and the number of tokens before the end of each group."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(left), pieces(right)
        for batch in batches:
            for lo, hi, _, _ in T.byte_slices(batch.column("text"), SLICE_BYTES):
                x = aligned(batch.column("text").slice(lo, hi - lo).to_pylist(), one, two)
                own = lambda values, at: [values[s:e] for s, e in zip(at, at[1:])]
                cuts = lambda cut, begin: [c - d for c, d in zip(own(cut[1:], x.doc_g), begin)]
                rows = own(x.a, x.doc_a), own(x.b, x.doc_b), cuts(x.group_a, x.doc_a), cuts(x.group_b, x.doc_b)
                arrays = [pa.array(r, pa.list_(pa.int64())) for r in rows]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *arrays], names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    schema = "doc_id long, a_ids array<long>, b_ids array<long>, a_cuts array<long>, b_cuts array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, schema)


def alignment(docs: DataFrame, left: str, right: bytes) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    ``left`` is the content of a byte-level tokenizer file, ``right`` that of a sentence-piece model.
    """
    slices = store.written(_slices(docs, left, right), "slices")
    pairs = store.written(_pairs(slices), "slice-pairs")
    counts = store.written(_counts(pairs, len(pieces(right).length)), "pair-counts")
    told = pairs.select("slice", "pair").join(counts, "pair")
    told = told.groupBy("slice").agg(F.collect_list(F.struct("pair", "count", "best")).alias("told"))
    whole = slices.join(told, "slice", "left").select("documents", "pairs", "cuts", "who", "times", "told")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                documents = batch.column("documents")[row].values
                count = len(documents)
                pair, cuts, who, times = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), kind) for c, kind in (("pairs", "<i8"), ("cuts", "<i4"), ("who", "<u4"), ("times", "<i8"))
                )
                best, total = np.zeros(count, np.int64), np.zeros(count, np.int64)
                if len(pair):
                    told = batch.column("told")[row].values
                    by = np.argsort(told.field("pair").to_numpy())
                    held = np.diff(cuts)
                    of = np.repeat(told.field("count").to_numpy()[by], held)
                    is_best = np.repeat(told.field("best").to_numpy(zero_copy_only=False)[by], held)
                    np.add.at(total, who, times * of)
                    np.add.at(best, who, times * is_best)
                columns = {f.name: documents.field(f.name) for f in documents.type}
                yield pa.RecordBatch.from_pydict(columns | {"n_best": best, "count_sum": total})

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return whole.mapInArrow(made, schema).select(*names)
