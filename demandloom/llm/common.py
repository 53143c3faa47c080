"""Shared storage, table access and distributed ranks for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one (group, bucket) that a window may sort in one task.
ROWS_PER_BUCKET = 20_000
#: Bytes of text that a Python task turns into objects at a time, words that it remembers, and the longest of those.
SLICE_BYTES, WORDS_KEPT, LONG_WORD = 1 << 20, 125_000, 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    On one machine (master ``local``) a temporary folder of the application takes its place where that is unset. On a
    cluster it must be set: a folder of one machine would lose rows there. The session's settings stay as they are.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own_dirs:
            _own_dirs[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="demandloom-")
        found = _own_dirs[context.applicationId]
    return found.rstrip("/")


_own_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A scope: what ``materialise`` writes inside of it is removed when it ends, so results must be used by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
        for path in paths:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str, codec: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors.

    The columns ``by`` become folders, so that filters on them leave files unread.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    for scope in _scopes:
        scope.append(path)
    df.write.parquet(path, partitionBy=list(by) or None, compression=codec)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete the folders of tables that ``materialise`` wrote and that nothing reads any more."""
    for df in written:
        _remove(df.sparkSession, df._written_to)


def cuts(values: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes in all; a longer value is a range of its own.

    Python objects made from a batch take many times its bytes, so tasks work on one range at a time.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(values):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield at, to
        at = to


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``size`` bytes of ``column``, without copying."""
    for batch in batches:
        for at, to in cuts(batch.column(column), size):
            yield batch.slice(at, to - at)


def text_parts(text: str, size: int = SLICE_BYTES) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut before a space or line break, so that no word is torn."""
    at = 0
    while len(text) - at > size:
        to = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if to < 0:
            to = min((x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x > 0), default=len(text))
        yield text[at:to]
        at = to
    yield text[at:]


class Recent(dict):
    """word -> make(word), of recent words: two generations of ``WORDS_KEPT``, so about 40 MB at most.

    What is asked for again moves to the younger one; words of over LONG_WORD characters are made anew each time.
    """

    def __init__(self, make: Callable[[str], Any]):
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> Any:
        out = self.older.get(word)
        if out is None:
            out = self.make(word)
            if len(word) > LONG_WORD:
                return out
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


_kept: tuple[Any, Any] = (None, None)


def worker_kept(key: Any, make: Callable[[], Any]) -> Any:
    """The one object that a worker process keeps between its tasks; another key's takes its place."""
    global _kept
    if _kept[0] != key:
        _kept = (None, None)
        _kept = (key, make())
    return _kept[1]


def packed(docs: DataFrame, name: str = "row") -> DataFrame:
    """``docs`` as one column of structs, so that columns beside it can't clash with any of its own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(name))


def own(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as no column of ``docs`` has (in any case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once a row however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def maybe_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only where the counted rows are at most ``limit``; else the planner's own join."""
    return F.broadcast(df) if rows <= limit else df


def bucket_bits(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Bits of a hash that split ``rows`` rows into buckets of about ``per_bucket``."""
    return max(2, (max(rows, 1) // per_bucket).bit_length() + 2)


def hash_bucket(hashed: Column, bits: int) -> Column:
    """The leading ``bits`` of a 64-bit hash, in the hash's own (signed) order."""
    return F.shiftright(hashed, 64 - bits)


def running(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], value: Column, name: str, before: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the group's rows before this one in (bucket, order).

    A group of any size is spread over its buckets: bucket totals are summed first, their
    running sums are joined back, and windows only ever sort one bucket. ``before`` names an
    optional column for the group's total. Ties in ``order`` should be interchangeable rows.
    Group columns must not be null.
    """
    keys = [*group, bucket]
    valued = df.withColumn("_v", value)
    totals = valued.groupBy(*keys).agg(F.sum("_v").alias("_bucket_sum"))
    w = Window.partitionBy(*group)
    offsets = totals.select(*keys, F.coalesce(F.sum("_bucket_sum").over(w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"), F.sum("_bucket_sum").over(w).alias("_group_sum"))
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = valued.join(offsets, keys).withColumn(name, F.col("_offset") + F.coalesce(F.sum("_v").over(inner), F.lit(0)))
    if before:
        out = out.withColumnRenamed("_group_sum", before)
    return out.drop("_v", "_offset", "_bucket_sum", "_group_sum")
