"""A store of feature grains: every grain computed and written once, months added or replaced one by one, queries only read.

Dated grains are tables in folders by month, bucketed and sorted by their key. Columns of the two pair grains are spread over
side tables with one bucketing, which join without an exchange, and a query joins the side tables that it needs. A write
replaces the months that it has rows for and no others. A manifest, to which rows are only ever added, says which
months of which grain are current and how many rows they have; it is written last, so a month that a failed write left
behind is not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.jobs.assembly import Parts
from demandloom.sources.io import path_exists, remove_path

#: Tables that are written side by side.
TABLES_AT_ONCE = 4
PAIR_DAY = ("shop_id", "item_id", "date")
KEYS = {
    "pairs": PAIR_DAY, "additional": PAIR_DAY, "pair_totals": ("shop_id", "item_id"), "shops": ("shop_id",), "items": ("item_id",), "dates": ("date",),
    "item_dates": ("item_id", "date"), "shop_dates": ("shop_id", "date"), "category_dates": ("shop_id", "item_category_id", "date"),
}
#: Side tables of a pair grain by how their columns begin, without the grain's prefix; what is left is the table "days".
SIDES = {"gaps": ("gap_", "days_since_", "first_", "sale_days_", "adi"), "quantities": ("qty_7d_", "qty_all_", "qty_cv2"), "changes": ("qty_lag", "prev_", "last_", "n_spikes", "had_spike"), "deviations": ("price_cv", "qty_mean_ad", "qty_median_ad")}
PAIR_GRAINS, PREFIX = ("pairs", "additional"), "sid_"
#: The age of a pair; it tells all features of additional pairs, whose days hold it.
AGE = f"{PREFIX}days_since_first_sale"
MANIFEST = "grain string, month int, rows long, version long"


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def _side(grain: str, column: str) -> str:
    if grain == PAIR_GRAINS[1] and column == AGE:
        return "days"
    bare = column.removeprefix(PREFIX)
    return next((side for side, begins in SIDES.items() if bare.startswith(begins)), "days")


def names_of(grain: str, sides: Sequence[str] = tuple(SIDES)) -> list[str]:
    """The tables of a grain, of pair grains with the chosen side tables."""
    return [f"{grain}_{side}" for side in ("days", *sides)] if grain in PAIR_GRAINS else [grain]


class GrainStore:
    """Grains below a folder that driver and executors share.

    A table of the store is registered under a name of its own for as long as the store is open; ``close`` drops those names
    and leaves the files, from which ``GrainStore(spark, root)`` opens the store again, ``delete`` removes both.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix, self.open, self._months = f"grain_{uuid.uuid4().hex[:12]}", {}, []
        self._some: dict[str, set[int]] = {}

    def _tables(self, grain: str, df: DataFrame) -> dict[str, list[str]]:
        """Names and columns of the tables that hold a grain."""
        if grain not in PAIR_GRAINS:
            return {grain: df.columns}
        rest = [c for c in df.columns if c not in PAIR_DAY]
        return {f"{grain}_{side}": [*PAIR_DAY, *columns] for side in ("days", *SIDES) if (columns := [c for c in rest if _side(grain, c) == side])}

    def _create(self, table: str, schema: str, keys: Sequence[str], found: bool = False) -> str:
        """The registered name of a table, which is created, or found in its folder with its months."""
        name = f"{self.prefix}_{table}"
        if table not in self.open:
            dated = "date" in keys
            self.spark.sql(
                f"CREATE TABLE {name} ({schema}{', month INT' if dated else ''}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {'PARTITIONED BY (month)' if dated else ''} "
                f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(keys)}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{table}'"
            )
            if dated and found:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
            self.open[table] = name
        return name

    def lacking(self, table: str, months: Collection[int]) -> frozenset[int]:
        """Those of the given months that no write of this session brought to a table; none if all its months were written at once."""
        if table in self.open and table not in self._some:
            return frozenset()
        return frozenset(months) - self._some.get(table, set())

    def put(self, parts: Parts, months: Sequence[int] | None = None, tables: Collection[str] | None = None) -> None:
        """Write all grains, or of the dated ones the given months alone; other months stay as they are.

        ``tables`` are the tables to write, all by default. A grain that is spread over several is computed once, to a folder from which they are written.
        """
        version = max((r["version"] for r in self.manifest().collect()), default=0) + 1
        staged = f"{self.root}/staged-{uuid.uuid4().hex}"
        written: list[tuple[str, str]] = []
        jobs = []
        before = set(self.open)

        def rows_of(grain: str) -> DataFrame:
            df = getattr(parts, grain)
            return df if months is None or "date" not in KEYS[grain] else df.filter(month_of(F.col("date")).isin(list(months)))

        chosen_of = {g: [t for t in names_of(g) if tables is None or t in tables] for g in (f.name for f in fields(parts))}
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(lambda g: rows_of(g).write.parquet(f"{staged}/{g}"), [g for g, names in chosen_of.items() if len(names) > 1]))
        for grain, names in chosen_of.items():
            if not names:
                continue
            df, keys = rows_of(grain), KEYS[grain]
            if len(names) > 1:
                df = self.spark.read.schema(df.schema).parquet(f"{staged}/{grain}")
            if "date" in keys:
                df = df.withColumn("month", month_of(F.col("date")))
            for k, (table, columns) in enumerate(self._tables(grain, df.drop("month")).items()):
                if table not in names:
                    continue
                chosen = df.select(*columns, *(["month"] if "date" in keys else []))
                schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.drop("month").schema)
                name = self._create(table, schema, keys)
                jobs.append((name, chosen, keys))
                if k == 0:
                    written.append((grain, name))

        def write(job: tuple[str, DataFrame, Sequence[str]]) -> None:
            name, df, keys = job
            df.repartition(self.buckets, *keys).write.mode("overwrite").insertInto(name, overwrite=True)

        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(write, jobs))
        for grain, names in chosen_of.items():
            for table in names:
                if months is None:
                    self._some.pop(table, None)
                elif "date" in KEYS[grain] and (table in self._some or table not in before):
                    self._some[table] = self._some.get(table, set()) | set(months)
        counts = None
        for grain, name in written:
            rows = self.spark.table(name)
            dated = "date" in KEYS[grain]
            mine = rows.filter(F.col("month").isin(list(months))) if dated and months is not None else rows
            of = mine.groupBy(F.col("month") if dated else F.lit(0).alias("month")).agg(F.count("*").alias("rows")).select(F.lit(grain).alias("grain"), "month", "rows", F.lit(version).cast("long").alias("version"))
            counts = of if counts is None else counts.unionByName(of)
        if counts is not None:
            counts.coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        remove_path(self.spark, staged)

    def manifest(self) -> DataFrame:
        """Rows (grain, month, rows, version) of what is current; month is 0 for grains without dates."""
        if not path_exists(self.spark, f"{self.root}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        written = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest")
        return written.groupBy("grain", "month").agg(F.max_by("rows", "version").alias("rows"), F.max("version").alias("version"))

    def _current(self, grain: str, table: str, first: date | None, last: date | None) -> DataFrame:
        df = self.spark.table(self.open[table])
        if "date" not in KEYS[grain]:
            return df
        known = self.months(grain)
        if first is not None:
            known = [m for m in known if first.year * 100 + first.month <= m <= last.year * 100 + last.month]
            df = df.filter(F.col("date").between(F.lit(first), F.lit(last)))
        return df.filter(F.col("month").isin(known)).drop("month")

    def months(self, grain: str = "pairs") -> list[int]:
        """The months of a grain that are current."""
        return sorted(r["month"] for r in self._months if r["grain"] == grain)

    def pair_days(self, first: date | None, last: date | None, sides: Sequence[str] = tuple(SIDES), additional: bool = False) -> DataFrame:
        """The days of pairs with the columns of the chosen side tables."""
        grain = PAIR_GRAINS[additional]
        df = self._current(grain, f"{grain}_days", first, last)
        for side in sides:
            df = df.join(self._current(grain, f"{grain}_{side}", first, last), list(PAIR_DAY))
        return df

    def parts(self, first: date | None = None, last: date | None = None, sides: Sequence[str] = tuple(SIDES), added_sides: Sequence[str] | None = None) -> Parts:
        """The grains of a period, months outside of which are never read; all there is without one. Those whose tables aren't written yet are None.

        Additional pairs come with the side tables ``added_sides``, by default with the same ones.
        """
        sides_of = {g: sides for g in (f.name for f in fields(Parts))} | ({} if added_sides is None else {PAIR_GRAINS[1]: added_sides})
        self._months = self.manifest().collect()  # a row for each grain and month
        self._reopen()
        found = [g for g in (f.name for f in fields(Parts)) if all(t in self.open for t in names_of(g, sides_of[g]))]
        grains = {g: self.pair_days(first, last, sides_of[g], g == PAIR_GRAINS[1]) if g in PAIR_GRAINS else self._current(g, g, first, last) for g in found}
        return Parts(**{f.name: grains.get(f.name) for f in fields(Parts)})

    def _reopen(self) -> None:
        """Register what an earlier session left in the folder."""
        for grain, keys in KEYS.items():
            for table in names_of(grain):
                if table not in self.open and path_exists(self.spark, f"{self.root}/{table}"):
                    found = self.spark.read.parquet(f"{self.root}/{table}").drop("month").schema
                    self._create(table, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found), keys, found=True)

    def close(self) -> None:
        for name in self.open.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.open = {}

    def delete(self) -> None:
        self.close()
        remove_path(self.spark, self.root)
