"""Scalar expressions over names, coordinates and zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_token(col: str | Column) -> Column:
    """The text before the first space."""
    return F.split_part(_c(col), F.lit(" "), F.lit(1))


def dms_to_decimal(col: str | Column) -> tuple[Column, Column]:
    """Latitude and longitude of two degree-minute(-second) triples; missing seconds count as 0, other texts give nulls."""
    c = _c(col)

    def part(no: int) -> Column:
        one = F.regexp_extract_all(c, F.lit(r"([0-9]+°[0-9]+′(?:[0-9]+″)?)"), 1)
        text = F.try_element_at(one, F.lit(no))
        take = lambda sign: F.coalesce(F.try_to_number(F.regexp_extract(text, rf"([0-9]+){sign}", 1), F.lit("9999")).cast("double"), F.lit(0.0))
        return F.when(text.isNotNull(), take("°") + take("′") / 60 + take("″") / 3600)

    return part(1), part(2)


def utc_offset(col: str | Column) -> Column:
    """The last character of a zone such as UTC+3, as a number."""
    return F.right(_c(col), F.lit(1)).cast("int")


def first_match(col: str | Column, groups: Sequence[tuple[str, str]]) -> Column:
    """The label of the first listed substring that the text contains, else the text itself."""
    c, out = _c(col), None
    for piece, label in groups:
        hit = F.contains(c, F.lit(piece))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return c if out is None else out.otherwise(c)


def contains_any(col: str | Column, pieces: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in pieces:
        out = out | F.contains(_c(col), F.lit(p))
    return F.coalesce(out, F.lit(False)).cast("int")
