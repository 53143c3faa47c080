"""Packing along a space-filling curve, so that sequences hold pieces of documents that resemble each other.

A document's ids are hashed into a signed vector, which is projected to few dimensions; its cell is a place on a Hilbert
curve. Documents are range-sorted by that place, their running token count gives each a place in one stream, and
sequences are the stream's cuts. Nothing is padded: what the last sequence leaves over is cut at powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, running, shuffle_partitions, slices, table
from demandloom.llm.tokens import default_tokenizer, text_ids

SEQUENCE = 1024
#: The curve fills a cube of DIMENSIONS x 2^BITS cells a side; ids are hashed to HASHED signed entries.
DIMENSIONS, BITS, HASHED, SEED = 4, 15, 1024, 12
TOKENIZER = "byte_bpe_50k.json"


class Projection:
    """Token ids are hashed to HASHED signed entries of a document's vector, whose damped counts are projected to few dimensions."""

    def __init__(self, ids: int, dimensions: int = DIMENSIONS, hashed: int = HASHED, seed: int = SEED):
        made = np.random.default_rng(seed)
        self.entry, self.sign = made.integers(0, hashed, ids), made.choice([-1.0, 1.0], ids)
        self.axes = made.choice([-1.0, 1.0], (hashed, dimensions))

    def vector(self, ids: np.ndarray) -> np.ndarray:
        """The hashed vector of a document, counts damped to their signed logarithm."""
        counts = np.bincount(self.entry.take(ids), self.sign.take(ids), len(self.axes))
        return np.copysign(np.log1p(np.abs(counts)), counts)

    def cells(self, documents: list[np.ndarray], bits: int = BITS) -> np.ndarray:
        """The cell of each document: its vector, scaled to unit length and projected, through a logistic curve.

        A text without ids lies in the middle.
        """
        vectors = np.array([self.vector(ids) for ids in documents]).reshape(-1, len(self.axes))
        at = vectors @ self.axes / np.sqrt(np.maximum((vectors * vectors).sum(axis=1, keepdims=True), 1e-9))
        return np.minimum((1 << bits) / (1 + np.exp(-1.702 * at)), (1 << bits) - 1).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``cells``; neighbouring places are neighbouring cells.

    Works from the largest half cubes down: within each, the lower bits are reflected or two axes change places, which
    turns the walk through the halves so that it ends next to where the following half begins. A Gray code over the
    dimensions then orders the halves.
    """
    x = cells.T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        half = 1 << level
        low = half - 1
        for d in range(n):
            upper = (x[d] & half) != 0
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= parity
    out = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def curve_places(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (row, doc_id, place, tie, n, ids): each text's ids with the end id as little-endian bytes, and its place.

    ``row`` numbers the rows of ``docs``; ``tie`` is equal for equal texts, which share their place.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, at = text_ids(tokenizer), TaskContext.get().partitionId() << 33
        projected = worker_kept_projection(cache.tokenizer.get_vocab_size(with_added_tokens=True))
        for batch in slices(batches, "text"):
            documents, ties, sizes, raws = [], [], [], []
            for text in batch.column("text"):
                raw = cache.raw(text.as_py())
                ids = np.frombuffer(raw, cache.kind)
                documents.append(ids)
                raw += end_id.to_bytes(cache.kind.itemsize, "little")
                ties.append(zlib.crc32(raw))
                sizes.append(len(ids) + 1)
                raws.append(raw)
            place = np.concatenate([np.zeros(0, np.int64), *(hilbert(projected.cells(documents[k : k + 256])) for k in range(0, len(documents), 256))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(at, at + batch.num_rows)), batch.column("doc_id"), pa.array(place), pa.array(ties, pa.int64()), pa.array(sizes, pa.int64()), pa.array(raws, pa.binary())],
                names=["row", "doc_id", "place", "tie", "n", "ids"],
            )
            at += batch.num_rows

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(places, "row long, doc_id long, place long, tie long, n long, ids binary")


_projected: dict[int, Projection] = {}


def worker_kept_projection(ids: int) -> Projection:
    """The projection of a worker process, made once."""
    if ids not in _projected:
        _projected.clear()
        _projected[ids] = Projection(ids)
    return _projected[ids]


def along_curve(places: DataFrame) -> tuple[DataFrame, int]:
    """(row, at): the ids before each document in curve order, and the number of all ids.

    Documents are range-sorted by place, then tie, then row, so equal documents stand together and a large
    group of them is split over ranges. Totals of ranges are summed first; windows only sort one range.
    """
    spark = places.sparkSession
    order = ["place", "tie", "row"]
    ranges = materialise(places.select(*order, "n").repartitionByRange(shuffle_partitions(spark), *order).withColumn("range", F.spark_partition_id()), "curve-ranges")
    total = ranges.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return running(ranges, [], "range", order, F.col("n"), "at").select("row", "at"), total


def tail_cuts(total: int, size: int) -> list[tuple[int, int]]:
    """(first position, length) of the sequences after the last full one: powers of two, longest first."""
    out, at = [], total - total % size
    while at < total:
        length = 1 << ((total - at).bit_length() - 1)
        out.append((at, length))
        at += length
    return out


def pack_along_curve(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents along the curve: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every sequence is full, but for at most log2(size) at the end, whose lengths are powers of two. A document is cut only
    where a sequence ends. Null and empty texts are their end id alone; very long texts run through as
    many sequences as they need; null ids and repeated rows keep their own pieces; equal texts stand
    together, in the order of their rows; other columns of ``docs``, whatever their names, play no part; an empty
    table gives an empty one.
    """
    places = materialise(curve_places(docs, tokenizer or default_tokenizer(TOKENIZER), end_id, id_col, text_col), "curve-places")
    starts, total = along_curve(places)
    tail = tail_cuts(total, size)
    whole = total - total % size
    begins = np.array([at for at, _ in tail] or [total], np.int64)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {x: [] for x in names}
            for doc_id, at, n, raw in zip(batch.column("doc_id").to_pylist(), batch.column("at").to_pylist(), batch.column("n").to_pylist(), batch.column("ids"), strict=True):
                data = raw.as_py()
                ids = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                view, start = memoryview(ids.tobytes()), 0
                while start < n:
                    where = at + start
                    if where < whole:
                        sequence, offset, room = where // size, where % size, size - where % size
                    else:
                        k = int(np.searchsorted(begins, where, "right")) - 1
                        sequence, offset = whole // size + k, where - tail[k][0]
                        room = tail[k][1] - offset
                    length = min(room, n - start)
                    for name, value in zip(names, (doc_id, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), n, sequence, offset), strict=True):
                        out[name].append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(out[x], pa.int64()) for x in names], names=names)

    joined = places.select("row", "doc_id", "n", "ids").join(starts.hint("shuffle_hash"), "row")
    return joined.select("doc_id", "at", "n", "ids").mapInArrow(cut, ", ".join(f"{x} long" for x in names))


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(table(spark, sf_dir, "documents"))
