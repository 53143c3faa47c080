"""Scaling and principal components from one moments aggregate; only matrices of columns reach the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Groups of tasks whose matrices are summed first.
GROUPS = 64


def _scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation (1 where it is 0) of each column."""
    found = df.agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(columns)), *(F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(columns))).first()
    return {c: (found[f"m{k}"] or 0.0, found[f"s{k}"] or 1.0) for k, c in enumerate(columns)}


def _scaled(columns: Sequence[str], scales: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: (F.col(c) - F.lit(scales[c][0])) / F.lit(scales[c][1]) for c in columns}


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as z-scores by population deviation; a constant column becomes 0."""
    return df.withColumns(_scaled(columns, _scales(df, columns)))


@dataclass(frozen=True)
class Components:
    """Fitted principal components [k, columns] of scaled columns, with their variances and shares of all variance."""

    columns: tuple[str, ...]
    scales: dict[str, tuple[float, float]]
    components: np.ndarray
    variances: np.ndarray
    ratios: np.ndarray

    def table(self, spark: SparkSession) -> DataFrame:
        """component (from 1), field, loading, variance, ratio."""
        rows = [(k + 1, c, float(w), float(self.variances[k]), float(self.ratios[k])) for k, v in enumerate(self.components) for c, w in zip(self.columns, v, strict=True)]
        return spark.createDataFrame(rows, "component int, field string, loading double, variance double, ratio double")


def gram(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Z'Z of the rows without a null, and their number, from one pass over blocks of rows.

    A task multiplies one Arrow batch after the other and sends one matrix; matrices are summed entry by entry, first within
    groups of tasks and then all. Only the sum, a matrix of columns, reaches the driver.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((len(columns), len(columns))), 0
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) if batch.num_rows else np.zeros((0, len(columns)))
            x = x[~np.isnan(x).any(axis=1)]
            total += x.T @ x
            n += len(x)
        flat = np.append(total.ravel(), n)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), task % GROUPS, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["part", "entry", "value"])

    sent = df.select(*(F.col(f"`{c}`").cast("double") for c in columns)).mapInArrow(blocks, "part int, entry int, value double")
    summed = sent.groupBy("part", "entry").agg(F.sum("value").alias("value")).groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(len(columns) ** 2 + 1)
    out[summed["entry"].to_numpy()] = summed["value"].to_numpy()
    return out[:-1].reshape(len(columns), len(columns)), int(out[-1])


def pca_fit(df: DataFrame, columns: Sequence[str], k: int) -> Components:
    """The ``k`` first components of scaled columns, with n - 1 in the covariance.

    Rows with a null in any column take no part. The loading of largest magnitude of each component is positive.
    """
    whole = df.dropna(subset=list(columns))
    scales = _scales(whole, columns)
    products, n = gram(whole.select(*(z.alias(c) for c, z in _scaled(columns, scales).items())), columns)
    values, vectors = np.linalg.eigh(products / max(n - 1, 1))
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order].T
    vectors = vectors * np.where(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    return Components(tuple(columns), scales, vectors[:k], values[:k], values[:k] / max(values.sum(), np.finfo(float).tiny))


def pca_transform(df: DataFrame, model: Components) -> DataFrame:
    """Scaled rows projected on each component as pc1, pc2, ...; null where a column is."""
    z = _scaled(model.columns, model.scales)
    return df.withColumns({f"pc{n + 1}": sum((z[c] * float(w) for c, w in zip(model.columns, v, strict=True)), F.lit(0.0)) for n, v in enumerate(model.components)})


def sample_rows(df: DataFrame, key: str, percent: int) -> DataFrame:
    """The same rows on every run and in every layout: those whose key hashes below ``percent`` of 100."""
    return df.filter(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(100)) < percent)
