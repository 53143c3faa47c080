"""Reading and writing of tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date as calendar_date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_table(spark: SparkSession, path: str, schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV file with a header and a known schema; only ``columns`` are parsed if given."""
    df = spark.read.schema(schema).csv(path, header=True)
    return df.select(*columns) if columns else df


def read_csv_prefix(spark: SparkSession, folder: str, schema: str, pattern: str = "*.csv") -> DataFrame:
    """All CSV files below a folder as one table."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).csv(folder, header=True)


def parse_dates_coerce(df: DataFrame, columns: Sequence[str], format: str = "yyyy-MM-dd") -> DataFrame:
    """Text columns as dates; what can't be parsed becomes null."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(format)).cast("date") for c in columns})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_counted(df: DataFrame, path: str, counts: Mapping[str, Column], **how) -> dict[str, int]:
    """Write a table as Parquet and return aggregates of its rows that the writing pass itself observes."""
    seen = Observation()
    df.observe(seen, *(c.alias(n) for n, c in counts.items())).write.parquet(path, **how)
    return seen.get


def replace_folder(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Replace what ``read_current`` finds below ``path``, all at once.

    Rows go to a folder of their own; only when the counts of the writing pass and of what can be read agree, and the columns
    too, is a pointer added that makes it the current one. A write that fails leaves what was current before,
    and neither it nor an older version leaves files behind.
    """
    spark, folder = df.sparkSession, f"version-{uuid.uuid4().hex}"
    older = _versions(spark, path)
    try:
        rows = write_counted(df, f"{path}/{folder}", {"n": F.count(F.lit(1))}, partitionBy=list(by) or None)["n"]
        stored = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
        found = stored.count()
        if found != rows or set(stored.dtypes) != set(df.dtypes):
            raise OSError(f"{found} of {rows} rows, {stored.dtypes} for {df.dtypes}")
    except Exception:
        remove_path(spark, f"{path}/{folder}")
        raise
    number = older[0]["number"] + 1 if older else 1
    spark.createDataFrame([(number, folder, rows, df.schema.json())], _POINTER).coalesce(1).write.mode("append").json(f"{path}/current")
    for x in older:
        remove_path(spark, f"{path}/{x['folder']}")
    return read_current(spark, path)


_POINTER = "number long, folder string, rows long, schema string"


def _versions(spark: SparkSession, path: str) -> list:
    """Pointers below a path, the latest first; none where nothing was written yet."""
    return spark.read.schema(_POINTER).json(f"{path}/current").orderBy(F.desc("number")).collect() if path_exists(spark, f"{path}/current") else []


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``replace_folder`` wrote last."""
    last = _versions(spark, path)[0]
    return spark.read.schema(StructType.fromJson(json.loads(last["schema"]))).parquet(f"{path}/{last['folder']}")


def write_table(df: DataFrame, name: str, root: str) -> DataFrame:
    """Create or replace the table ``name``, whose files lie below ``root``; its old rows stay readable until the new ones are complete."""
    spark = df.sparkSession
    replace_folder(df, f"{root}/{name}")
    place = f"{root}/{name}/{_versions(spark, f'{root}/{name}')[0]['folder']}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str, root: str) -> None:
    """Drop a table of ``write_table`` with its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove_path(spark, f"{root}/{name}")


def create_table_as(spark: SparkSession, name: str, sql: str, root: str) -> DataFrame:
    return write_table(spark.sql(sql), name, root)


def read_table_cast(df: DataFrame, types: Mapping[str, str], path: str) -> tuple[DataFrame, dict[str, int]]:
    """The table written to ``path`` with columns cast by name, and the count of values that can't be cast.

    One pass writes the columns and their casts and observes the failures; a column with any stays as it is.
    """
    known = {c: t for c, t in types.items() if c in df.columns}
    cast = {f"_cast{k}": F.col(c).try_cast(t) for k, (c, t) in enumerate(known.items())}
    lost = {c: F.count_if(F.col(c).isNotNull() & F.col(k).isNull()) for c, k in zip(known, cast, strict=True)}
    failed = {c: int(n) for c, n in write_counted(df.withColumns(cast), path, lost).items()} if known else {}
    if not known:
        df.write.parquet(path)
    stored, places = df.sparkSession.read.parquet(path), dict(zip(known, cast, strict=True))
    return stored.select(*(F.col(places[c]).alias(c) if c in known and not failed[c] else F.col(c) for c in df.columns)), failed


def query_to_csv(spark: SparkSession, sql: str, path: str) -> None:
    write_csv(spark.sql(sql), path)


def export_months(df: DataFrame, path: str, date: str = "date") -> DataFrame:
    """Rows in folders by month (yr_mon=yyyymm), so that reading one month prunes all others; replaced all at once."""
    return replace_folder(df.withColumn("yr_mon", F.year(date) * 100 + F.month(date)), path, ["yr_mon"])


def export_month(df: DataFrame, year: int, month: int, path: str, date: str = "date") -> int:
    """One month of a table, as Parquet files named by it, and its rows; the range of its dates reaches the scan."""
    first = calendar_date(year, month, 1)
    after = calendar_date(year + month // 12, month % 12 + 1, 1)
    mine = df.filter((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(after)))
    return write_counted(mine, f"{path}/{year}{month:02d}", {"n": F.count(F.lit(1))}, mode="overwrite")["n"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a local one only on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="demandloom-")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A scope: what operators write to ``scratch_path`` inside of it is removed when it ends, so results must be used by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove_path(spark, path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    files, where = _file_system(spark, path)
    files.delete(where, True)
