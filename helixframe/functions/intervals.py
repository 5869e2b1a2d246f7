"""Column functions on half-open intervals [start, end)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName | int) -> Column:
    return F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x


def overlaps(start_a: ColumnOrName, end_a: ColumnOrName, start_b: ColumnOrName, end_b: ColumnOrName) -> Column:
    """Strict overlap of two half-open intervals."""
    return (_c(start_a) < _c(end_b)) & (_c(end_a) > _c(start_b))


def truncated_div(x: ColumnOrName, by: ColumnOrName | int) -> Column:
    """Integer division that truncates toward zero, also for negative values."""
    return F.call_function("div", _c(x).cast("long"), _c(by).cast("long"))


def bins(start: ColumnOrName, end: ColumnOrName, size: int) -> Column:
    """array<struct<binId int, isLastBin boolean>> of all bins that [start, end) touches; null for a null end point, empty
    for an empty interval. Bin numbers beyond 32 bits are an error, as the cast is checked."""
    first, last = truncated_div(start, size), truncated_div(_c(end) - 1, size)
    numbers = F.when(_c(start).isNull() | _c(end).isNull(), None).when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda b: F.struct(b.cast("int").alias("binId"), (b == last).alias("isLastBin")))


def is_duplicate_bin(start: ColumnOrName, bin_id: ColumnOrName, size: int) -> Column:
    """Whether the interval starts before the bin, so an earlier bin holds the same row."""
    return _c(start) < _c(bin_id).cast("long") * size


def intersect(start_a: ColumnOrName, end_a: ColumnOrName, start_b: ColumnOrName, end_b: ColumnOrName) -> Column:
    """struct<start, end> of the common part, null where there is none."""
    a, b = F.greatest(_c(start_a), _c(start_b)), F.least(_c(end_a), _c(end_b))
    return F.when(a < b, F.struct(a.alias("start"), b.alias("end")))


def closed(start: ColumnOrName, end: ColumnOrName) -> Column:
    """struct<start, end> of the same interval in one-based closed coordinates."""
    return F.struct((_c(start) + 1).alias("start"), _c(end).alias("end"))


def callable_point(point: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whether a one-based point lies in a one-based closed interval: keeps one of the copies that padding makes."""
    return _c(point).between(_c(start), _c(end))


def any_region(contig: ColumnOrName, start: ColumnOrName, end: ColumnOrName, regions: list[tuple[str, int, int]]) -> Column:
    """One disjunction of literal region tests, which reaches a Parquet scan; false for no regions."""
    out = F.lit(False)
    for k, (c, s, e) in enumerate(regions):
        test = (_c(contig) == c) & (_c(start) < e) & (_c(end) > s)
        out = test if k == 0 else out | test
    return out
