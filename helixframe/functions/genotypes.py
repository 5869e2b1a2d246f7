"""Genotype arithmetic and other scalar helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-6


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def genotype_count(ploidy: Column | str, alleles: Column | str) -> Column:
    """How many unordered genotypes `alleles` alleles have at a ploidy: C(ploidy + alleles - 1, ploidy), by the running
    product; -1 where it exceeds 64-bit arithmetic's safe range."""
    p, n = _c(ploidy).cast("long"), _c(alleles).cast("long")
    step = lambda acc, k: F.when((acc < 0) | (acc > (1 << 62) / (n + k)), F.lit(-1).cast("long")).otherwise(F.call_function("div", acc * (n - 1 + k), k))
    return F.when(p < 1, F.lit(1).cast("long")).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(p, F.lit(1).cast("long"))), F.lit(1).cast("long"), step))


def most_alleles(ploidy: int, genotypes: int) -> int:
    """The largest number of alleles that has at most `genotypes` genotypes at a ploidy."""
    from math import comb

    n = 1
    while comb(ploidy + n, ploidy) <= genotypes:
        n += 1
    return n


def has_valid_pls(n_alt: Column | str, copy_number: Column | str, n_pl: Column | str, n_gl: Column | str) -> Column:
    """Whether a genotype has enough likelihoods: none at all, or at least as many as it has possible genotypes. Phred
    likelihoods count before plain ones; a copy number below 1 is always valid; more than expected is valid."""
    cn, pl, gl = (F.coalesce(_c(x).cast("long"), F.lit(0).cast("long")) for x in (copy_number, n_pl, n_gl))
    actual = F.when(pl > 0, pl).when(gl > 0, gl)
    expected = genotype_count(cn, F.coalesce(_c(n_alt).cast("long"), F.lit(0).cast("long")) + 1)
    return (cn < 1) | actual.isNull() | (expected <= F.coalesce(actual, F.lit(0)))


#: The smallest normal double; no margin is smaller.
LEAST_MARGIN = 2.2250738585072014e-308


def nearly_equal(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    """Equal, or apart by at most `tolerance` of the larger magnitude."""
    x, y = _c(a), _c(b)
    return (x == y) | (F.abs(x - y) <= F.greatest(F.lit(LEAST_MARGIN), tolerance * F.greatest(F.abs(x), F.abs(y))))


def nearly_less(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    return ~nearly_equal(a, b, tolerance) & (_c(a) < _c(b))


def nearly_less_equal(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    return nearly_equal(a, b, tolerance) | (_c(a) < _c(b))


def nearly_greater(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    return nearly_less(b, a, tolerance)


def nearly_greater_equal(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    return nearly_less_equal(b, a, tolerance)


def duration(seconds: Column | str) -> Column:
    """Whole seconds as XhYmZs."""
    s = _c(seconds).cast("long")
    part = lambda x: x.cast("string")
    return F.concat(part(F.call_function("div", s, F.lit(3600).cast("long"))), F.lit("h"), part(F.call_function("div", s % 3600, F.lit(60).cast("long"))), F.lit("m"), part(s % 60), F.lit("s"))
