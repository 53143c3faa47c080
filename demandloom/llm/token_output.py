"""Token-id output in patched frame-of-reference blocks.

A segment is one binary value that describes itself. Its ids are cut into blocks of 128;
each block stores its minimum, packs the differences at the width that holds its 90th
percentile, and keeps what doesn't fit in an exception list of (place, high bits). An index
holds the byte where each block starts, so that single blocks can be read alone.

Segments are rows of a Parquet dataset, so any store that Spark writes to can hold them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, shuffle_partitions, slices, table
from demandloom.llm.tokens import TEXTS_BYTES, default_tokenizer, text_ids

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 17
_HEAD = struct.Struct("<4sIIII")
_SLICE = 4096


def _bit_length(x: np.ndarray) -> np.ndarray:
    """Bits that hold each value; 0 for 0."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    """The reverse of _pack for rows of BLOCK values: each value lies in 5 bytes at most."""
    at = np.arange(BLOCK) * width
    wide = np.zeros((len(packed), packed.shape[1] + 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    out = np.zeros((len(packed), BLOCK), np.uint64)
    for k in range((width + 14) // 8):
        out |= wide[:, at // 8 + k].astype(np.uint64) << np.uint64(8 * k)
    return ((out >> (at % 8).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def encode_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One segment of unsigned 32-bit ``ids`` that hold the documents' ids one after another."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.full(blocks * BLOCK, ids[-1] if n else 0, np.uint32)
    full[:n] = ids
    full = full.reshape(blocks, BLOCK)
    base = full.min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = full - base[:, None]
    nth = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bit_length(np.partition(delta, nth, axis=1)[:, nth]) if blocks else np.zeros(0, np.uint8)
    high = (delta.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype(np.uint32)
    over_block, over_place = np.nonzero(high)
    sizes = width.astype(np.uint32) * (BLOCK // 8)
    starts = np.zeros(blocks + 1, np.uint32)
    np.cumsum(sizes, out=starts[1:])
    payload = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width[width > 0]):
        rows = np.nonzero(width == w)[0]
        for k in range(0, len(rows), _SLICE):
            part = rows[k : k + _SLICE]
            at = starts[part, None] + np.arange(int(w) * BLOCK // 8, dtype=np.uint32)
            payload[at] = _pack(delta[part] & np.uint32((1 << int(w)) - 1), int(w))
    known = np.array([x is not None for x in doc_ids], np.uint8)
    named = np.array([0 if x is None else x for x in doc_ids], "<i8")
    return b"".join(
        [
            _HEAD.pack(MAGIC, n, BLOCK, len(doc_ids), len(over_block)),
            named.tobytes(), known.tobytes(), np.array(lengths, "<u4").tobytes(),
            starts.astype("<u4").tobytes(), base.astype("<u4").tobytes(), width.tobytes(),
            over_block.astype("<u4").tobytes(), over_place.astype(np.uint8).tobytes(), high[over_block, over_place].astype("<u4").tobytes(),
            payload.tobytes(),
        ]
    )


class Segment:
    """The parts of a segment, without its packed differences unpacked."""

    def __init__(self, data: bytes):
        magic, self.n, block, docs, overs = _HEAD.unpack_from(data)
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a segment of this format")
        self.blocks, at = -(-self.n // BLOCK), _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        named, known, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.doc_ids = [int(x) if ok else None for x, ok in zip(named, known, strict=True)]
        self.starts, self.base, self.width = take("<u4", self.blocks + 1), take("<u4", self.blocks), take("u1", self.blocks)
        self.over_block, self.over_place, self.high = take("<u4", overs), take("u1", overs), take("<u4", overs)
        self.payload = np.frombuffer(data, np.uint8, int(self.starts[-1]), at)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks [first, last), found by the index of block starts; of all blocks by default."""
        last = self.blocks if last is None else min(last, self.blocks)
        width, starts = self.width[first:last], self.starts[first:last]
        delta = np.zeros((len(width), BLOCK), np.uint32)
        for w in np.unique(width[width > 0]):
            rows = np.nonzero(width == w)[0]
            for k in range(0, len(rows), _SLICE):
                part = rows[k : k + _SLICE]
                delta[part] = _unpack(self.payload[starts[part, None] + np.arange(int(w) * BLOCK // 8, dtype=np.uint32)], int(w))
        a, b = np.searchsorted(self.over_block, [first, last])  # exceptions are in order of blocks
        blocks = self.over_block[a:b] - np.uint32(first)
        delta[blocks, self.over_place[a:b]] |= self.high[a:b] << width[blocks].astype(np.uint32)
        return (delta + self.base[first:last, None]).reshape(-1)[: self.n - first * BLOCK]

    def slice(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, of which only the blocks that hold them are unpacked."""
        first = start // BLOCK
        return self.ids(first, -(-(start + count) // BLOCK))[start - first * BLOCK :][:count]


def decode_segment(data: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """ids, doc ids and lengths of one segment."""
    found = Segment(data)
    return found.ids(), found.doc_ids, found.lengths


def read_documents(segments: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id and token ids of the documents of ``wanted`` (one id a row), from the blocks that hold them.

    Ids that no segment holds, and null ids, give no row; an id that several documents share gives each.
    """
    inside = segments.select("part", "segment", "data").mapInArrow(_places, "part int, segment int, doc_id long, at long, n long")
    asked = wanted.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    places = inside.join(asked, "doc_id", "left_semi").groupBy("part", "segment").agg(F.collect_list(F.struct("doc_id", "at", "n")).alias("places"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            for data, found in zip(batch.column("data"), batch.column("places").to_pylist(), strict=True):
                held = Segment(data.as_py())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([x["doc_id"] for x in found], pa.int64()), "ids": pa.array([held.slice(x["at"], x["n"]).astype(np.int64) for x in found], pa.list_(pa.int64()))})

    return segments.join(places, ["part", "segment"]).select("data", "places").mapInArrow(read, "doc_id long, ids array<long>")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each document lies in its segment; only the segment's head is read."""
    for batch in slices(batches, "data"):
        for part, segment, data in zip(batch.column("part"), batch.column("segment"), batch.column("data"), strict=True):
            held = Segment(data.as_py())
            n = held.lengths.astype(np.int64)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part.as_py()] * len(n), pa.int32()), "segment": pa.array([segment.as_py()] * len(n), pa.int32()), "doc_id": pa.array(held.doc_ids, pa.int64()), "at": pa.array(np.cumsum(n) - n), "n": pa.array(n)})


def write_token_segments(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", label: str = "token-segments") -> DataFrame:
    """Encode every text and write its ids, in ascending ``id_col`` order, as segments; returns the written table.

    Columns: part, segment (place in part), before (ids of the part before it), n_ids, data.
    Documents are range-partitioned by id, so parts follow one another in id order. A null
    text counts as empty (its end id alone); null ids come last; rows that share an id are
    ordered by a hash of their text; very long texts are encoded whole; other columns of ``docs``, whatever their names, play
    no part; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = text_ids(tokenizer), TaskContext.get().partitionId()
        held, names, lengths, count, segment, before = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            data = encode_segment(np.concatenate(held), names, lengths)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()), "before": pa.array([before], pa.int64()), "n_ids": pa.array([count], pa.int64()), "data": pa.array([data], pa.binary())})

        for batch in slices(batches, "text", TEXTS_BYTES):
            ids, sizes = cache.ids_of(batch.column("text"), end_id)
            to = 0
            for doc_id, size in zip(batch.column("doc_id").to_pylist(), sizes.tolist(), strict=True):
                held.append(ids[to : to + size])
                names.append(doc_id)
                lengths.append(size)
                count, to = count + size, to + size
                if count >= SEGMENT_IDS:
                    yield flush()
                    held, names, lengths, before, segment, count = [], [], [], before + count, segment + 1, 0
        if held:
            yield flush()

    return materialise(ordered.mapInArrow(encode, "part int, segment int, before long, n_ids long, data binary"), label)


def read_token_segments(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the written segments.

    start counts all ids of earlier documents over the whole dataset; only totals of parts
    (as many rows as the writer had partitions) are gathered for it.
    """
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = segments.groupBy("part").agg(F.sum("n_ids").alias("_n")).select("part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("part_start"))
    placed = segments.join(F.broadcast(offsets), "part").select((F.col("part_start") + F.col("before")).alias("start"), "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            for start, data in zip(batch.column("start").to_pylist(), batch.column("data"), strict=True):
                ids, names, lengths = decode_segment(data.as_py())
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(names, pa.int64()), "start": pa.array(starts + start, pa.int64()), "n_tokens": pa.array(lengths.astype(np.int64)), "ids_crc32": pa.array(crcs, pa.int64())})

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_segments(write_token_segments(table(spark, sf_dir, "documents"), default_tokenizer()))
