"""Best-fit packing planned on a histogram of piece lengths.

Best-fit decreasing runs over (length, count) pairs, at most one per length, and never over
documents: bins with equal contents are one group with a count. The plan says, for ranks
[from, to) among the pieces of a length, which sequences they go to and where. Pieces then
take their slots by joining on length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import bucket_bits, hash_bucket, materialise, maybe_broadcast, running, slices, table
from demandloom.llm.tokens import default_tokenizer, text_ids

SEQUENCE = 2048
#: Ranks of one block in which pieces of a length look for their slot.
RANKS = 4_096
BROADCAST_ROWS = 200_000


def plan_best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from_rank, to_rank, first_sequence, per_sequence, first_offset).

    The piece of rank r goes to sequence first_sequence + (r - from_rank) // per_sequence, at
    offset first_offset + ((r - from_rank) % per_sequence) * length. Lengths are taken
    longest first, each into the open bins with the least room that holds it.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first sequence, how many, tokens used)
    plan, opened = [], 0

    def keep(first: int, many: int, used: int) -> None:
        room = size - used
        if many and room:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, many, used))

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many, used = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, used = size, 0
                many = -(-left // (size // length))
                first, opened = opened, opened + many
            each = room // length
            whole = min(many, left // each)
            if whole:
                plan.append((length, rank, rank + whole * each, first, each, used))
                keep(first, whole, used + each * length)
                rank, left = rank + whole * each, left - whole * each
            rest = many - whole
            if rest and left:  # fewer pieces than one bin takes
                plan.append((length, rank, rank + left, first + whole, left, used))
                keep(first + whole, 1, used + left * length)
                whole, rest, left = whole + 1, rest - 1, 0
            keep(first + whole, rest, used)
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``size`` ids of every text with its end id: doc_id, piece, start, length, ids_crc32.

    Only texts over ``size`` ids are cut; very long ones are encoded whole. A null text counts as empty (its end id alone);
    other columns of ``docs``, whatever their names, play no part; null ids and repeated rows keep their own pieces; an empty table gives none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = text_ids(tokenizer)
        for batch in slices(batches, "text"):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = memoryview(cache.ids(text.as_py(), end_id).tobytes())
                for piece, at in enumerate(range(0, len(raw), 4 * size)):
                    part = raw[at : at + 4 * size]
                    for name, x in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[name].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()), *(pa.array(out[x], pa.int64()) for x in ("start", "length", "ids_crc32"))], names=list(out))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece, start, length, ids_crc32.

    The driver holds one count per length (at most ``size``) and the plan made of it. Ranks
    within a length come from hash buckets, so a length that many pieces share is spread
    over tasks; pieces meet their slots by length and block of ranks, so each looks at few slots.
    Identical rows are interchangeable. Lengths must be from 1 to ``size``.
    """
    spark = pieces.sparkSession
    pieces = materialise(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_best_fit(histogram, size)
    slots = spark.createDataFrame(plan or [(0, 0, 0, 0, 1, 0)], "length long, from_rank long, to_rank long, first_sequence long, per_sequence long, first_offset long")
    block = lambda rank: F.floor(rank / RANKS).cast("long")
    slots = slots.withColumn("block", F.explode(F.sequence(block(F.col("from_rank")), block(F.greatest(F.col("to_rank"), F.lit(1)) - 1))))
    n_slots = len(plan) + sum(histogram.values()) // RANKS + len(histogram)  # the most that the line above can make
    hashed = pieces.withColumn("_h", F.xxhash64("doc_id", "piece", "ids_crc32", "start"))
    ranked = running(hashed.withColumn("_b", hash_bucket(F.col("_h"), bucket_bits(sum(histogram.values())))), ["length"], "_b", ["_h", "doc_id", "piece", "start", "ids_crc32"], F.lit(1).cast("long"), "_rank")
    p, s = ranked.withColumn("block", block(F.col("_rank"))).alias("p"), maybe_broadcast(slots, n_slots, BROADCAST_ROWS).alias("s")
    at = F.col("p._rank") - F.col("s.from_rank")
    return p.join(s, (F.col("p.length") == F.col("s.length")) & (F.col("p.block") == F.col("s.block")) & (F.col("p._rank") >= F.col("s.from_rank")) & (F.col("p._rank") < F.col("s.to_rank"))).select(
        *(f"p.{c}" for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
        (F.col("s.first_sequence") + F.floor(at / F.col("s.per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("s.first_offset") + F.pmod(at, F.col("s.per_sequence")) * F.col("p.length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are pieces of their end id alone; very long texts are cut into pieces of
    ``size``; null ids and repeated rows keep their own pieces; pieces of equal length are
    interchangeable, ties go by hash; other columns of ``docs``, whatever their names, play no part;
    an empty table gives an empty one.
    """
    return pack_pieces(token_pieces(docs, tokenizer or default_tokenizer(), size, end_id), size)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
