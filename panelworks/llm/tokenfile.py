"""Token ids in binary files, with document boundaries as Elias-Fano sequences.

A shard holds the ids of a range of documents in ascending order of their ids, one after the other, in
two or four bytes each. Where the documents end is a growing sequence of n numbers below u; its
Elias-Fano form takes about 2 + log2(u / n) bits for each: the low bits as they are, the high bits
as distances in unary. A sample of the positions of ones gives any offset without reading the
numbers before it. The document ids of a shard are stored the same way.

A null text has the end id only. Rows without an id come first. Rows that repeat an id stand next to
each other, in the order of a hash of their texts. An empty table makes no shard.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm import encode, files, store

MAGIC = b"PWIDS001"
#: Ones between two sampled positions.
SAMPLE = 256
#: Documents read at a time.
READ_DOCUMENTS = 512


@dataclass
class EliasFano:
    """A sequence that does not fall, of ``count`` numbers from 0."""

    count: int
    low_bits: int
    low: np.ndarray  # packed low bits
    high: np.ndarray  # one set bit for each number
    samples: np.ndarray  # position of every SAMPLE-th set bit

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = values & np.uint64((1 << bits) - 1)
        grid = ((low[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        samples = ones[::SAMPLE]
        kind = np.uint32 if not n or ones[-1] < 1 << 32 else np.uint64
        return EliasFano(n, bits, np.packbits(grid.ravel(), bitorder="little"), np.packbits(unary, bitorder="little"), samples.astype(kind))

    def select(self, first: int, last: int) -> np.ndarray:
        """Numbers ``first`` to ``last - 1``, by way of the samples around them."""
        if last <= first:
            return np.zeros(0, np.int64)
        block = first // SAMPLE
        start = int(self.samples[block])
        after = (last - 1) // SAMPLE + 1
        end = int(self.samples[after]) if after < len(self.samples) else len(self.high) * 8
        base = start // 8
        bits = np.unpackbits(self.high[base : -(-end // 8)], bitorder="little")
        ones = np.flatnonzero(bits) + base * 8
        ones = ones[ones >= start][first - block * SAMPLE : last - block * SAMPLE]
        number = np.arange(first, last)
        return ((ones - number) << self.low_bits) | self._low(number)

    def _low(self, number: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(number), np.int64)
        at = number * self.low_bits
        padded = np.concatenate([self.low, np.zeros(9, np.uint8)])
        window = padded[(at >> 3)[:, None] + np.arange(8)].copy().view("<u8").ravel()
        shift = (at & 7).astype(np.uint64)
        value = window >> shift
        if self.low_bits > 56:
            # the last bits lie in a ninth byte
            ninth = padded[(at >> 3) + 8].astype(np.uint64) << (np.uint64(64) - shift)
            value |= np.where(shift > 0, ninth, np.uint64(0))
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def to_bytes(self) -> bytes:
        wide = self.samples.dtype.itemsize
        head = struct.pack("<QIIQQQ", self.count, self.low_bits, wide, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> EliasFano:
        count, bits, wide, low, high, samples = struct.unpack_from("<QIIQQQ", raw)
        at = struct.calcsize("<QIIQQQ")
        return EliasFano(
            count,
            bits,
            np.frombuffer(raw, np.uint8, low, at),
            np.frombuffer(raw, np.uint8, high, at + low),
            np.frombuffer(raw, np.uint32 if wide == 4 else np.uint64, samples, at + low + high),
        )


class ShardWriter:
    """Ids go out as they come; the boundaries and document ids follow at the end."""

    def __init__(self, out, width: int) -> None:
        self.out, self.width = out, width
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.sizes: list[np.ndarray] = []
        self.names: list[int] = []
        self.unnamed = 0
        self.ids = 0

    def add(self, names: list[int | None], ids: np.ndarray, offsets: np.ndarray) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.sizes.append(np.diff(offsets).astype(np.uint32))
        self.ids += len(ids)
        for name in names:
            if name is None:
                self.unnamed += 1
            else:
                self.names.append(name)

    def close(self) -> int:
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.uint32)
        bounds = EliasFano.of(np.concatenate([[0], np.cumsum(sizes, dtype=np.uint64)])).to_bytes()
        base = self.names[0] if self.names else 0
        shifted = np.array([n - base for n in self.names], np.uint64)
        names = EliasFano.of(shifted).to_bytes()
        head = json.dumps(
            {"width": self.width, "documents": len(sizes), "ids": self.ids, "bounds": len(bounds), "names": len(names), "base": base, "unnamed": self.unnamed}
        ).encode()
        self.out.write(bounds + names + head + struct.pack("<I", len(head)) + MAGIC)
        return len(sizes)


class Shard:
    """A shard file opened for reading; any document is found by ``select`` on the boundaries."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = struct.calcsize("<I") + len(MAGIC)
        raw = source.read_at(tail, size - tail)
        if raw[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a shard of token ids")
        length = struct.unpack_from("<I", raw)[0]
        head = json.loads(source.read_at(length, size - tail - length))
        at = head["ids"] * head["width"]
        self.width, self.documents, self.ids = head["width"], head["documents"], head["ids"]
        self.base, self.unnamed = head["base"], head["unnamed"]
        self.bounds = EliasFano.from_bytes(source.read_at(head["bounds"], at))
        self.names = EliasFano.from_bytes(source.read_at(head["names"], at + head["bounds"]))

    def read(self, first: int, last: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Document ids, token ids and boundaries (counted in the shard) of a run of documents."""
        bounds = self.bounds.select(first, last + 1)
        raw = self.source.read_at(int(bounds[-1] - bounds[0]) * self.width, int(bounds[0]) * self.width)
        ids = np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")
        none = max(0, min(last, self.unnamed) - first)
        names = self.names.select(max(first, self.unnamed) - self.unnamed, max(last, self.unnamed) - self.unnamed)
        return [None] * none + (names + self.base).tolist(), ids, bounds


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end: int = 2) -> DataFrame:
    """Write all ``docs`` in ascending order of their ids: (shard, path, documents, ids, start).

    ``start`` is the number of ids in earlier shards. Shards are ranges of the document ids, so their order
    is that of the partitions.
    """
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)
    vocabulary = max([*json.loads(tokenizer)["model"]["vocab"].values(), *(t["id"] for t in json.loads(tokenizer).get("added_tokens", ())), end])
    width = 2 if vocabulary < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}.ids"

        def rest() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        with files.new_file(path) as out:
            writer = ShardWriter(out, width)
            for batch in rest():
                for lo, hi, ids, offsets in encode.encoded_slices(batch.column("text"), content.value):
                    writer.add(batch.column("doc_id")[lo:hi].to_pylist(), *encode.with_end(ids, offsets, end))
            documents = writer.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int64()), "path": [path], "documents": pa.array([documents], pa.int64()), "ids": pa.array([writer.ids], pa.int64())}
        )

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    shards = store.written(rows.mapInArrow(write, "shard long, path string, documents long, ids long"), "shards")
    # one row for each shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = files.opened(row["path"])
                with system.open_input_file(path) as source:
                    shard = Shard(source)
                    for first in range(0, shard.documents, READ_DOCUMENTS):
                        names, ids, bounds = shard.read(first, min(shard.documents, first + READ_DOCUMENTS))
                        raw = memoryview(ids).cast("B")
                        at = ((bounds - bounds[0]) * 4).tolist()
                        yield pa.RecordBatch.from_pydict(
                            {
                                "doc_id": pa.array(names, pa.int64()),
                                "start": pa.array(bounds[:-1] + row["start"], pa.int64()),
                                "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                                "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                            }
                        )

    return store.spread(shards, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
