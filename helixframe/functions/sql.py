"""The engine's functions for SQL text: temporary SQL functions, so queries stay in built-in expressions."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "overlaps": "(a_start BIGINT, a_end BIGINT, b_start BIGINT, b_end BIGINT) RETURNS BOOLEAN RETURN a_start < b_end AND a_end > b_start",
    "genotype_count": "(ploidy BIGINT, alleles BIGINT) RETURNS BIGINT RETURN CASE WHEN ploidy < 1 THEN 1 ELSE aggregate(sequence(1L, greatest(ploidy, 1L)), 1L, (acc, k) -> (acc * (alleles - 1 + k)) div k) END",
    "has_valid_pls": "(n_alt BIGINT, copy_number BIGINT, n_pl BIGINT, n_gl BIGINT) RETURNS BOOLEAN RETURN coalesce(copy_number, 0) < 1 OR (coalesce(n_pl, 0) <= 0 AND coalesce(n_gl, 0) <= 0) OR genotype_count(coalesce(copy_number, 0), coalesce(n_alt, 0) + 1) <= CASE WHEN n_pl > 0 THEN n_pl ELSE n_gl END",
    "bins": "(a_start BIGINT, a_end BIGINT, size BIGINT) RETURNS ARRAY<STRUCT<binId: INT, isLastBin: BOOLEAN>> RETURN CASE WHEN a_start IS NULL OR a_end IS NULL THEN NULL WHEN (a_end - 1) div size >= a_start div size THEN transform(sequence(a_start div size, (a_end - 1) div size), b -> named_struct('binId', cast(b AS INT), 'isLastBin', b = (a_end - 1) div size)) ELSE cast(array() AS ARRAY<STRUCT<binId: INT, isLastBin: BOOLEAN>>) END",
}


#: Functions that give rows, for FROM and LATERAL. Spark joins their rows back to distinct arguments; over very many
#: different ones LATERAL VIEW inline(bins(...)) needs no join.
TABLES = {
    "bins_of": "(a_start BIGINT, a_end BIGINT, size BIGINT) RETURNS TABLE (binId INT, isLastBin BOOLEAN) RETURN SELECT cast(b AS INT), b = (a_end - 1) div size FROM explode(sequence(a_start div size, greatest((a_end - 1) div size, a_start div size))) AS t(b) WHERE (a_end - 1) div size >= a_start div size",
}


def register(spark: SparkSession) -> None:
    """Make overlaps, genotype_count, has_valid_pls, bins and the table function bins_of callable in spark.sql."""
    for name, body in (FUNCTIONS | TABLES).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
