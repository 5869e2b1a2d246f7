"""Joins and filters on genomic intervals.

Spark has no range join of its own beyond a nested loop, so both sides are cut into bins and joined on (contig, bin) with
the overlap as residual condition. Bins come in levels, each eight times as wide as the one before: an interval lives in the
lowest level whose bins are as long as it, so it is in two bins at most however long it is, and it visits the bins around it of
those higher levels that the other side has intervals of. Which levels there are is asked first, in a pass over the ends
alone; where all intervals are short there is one level and one kind of row. A pair meets in the higher of its two levels, and if
it shares both bins there, in the first of them only, so binning adds no copies and needs no distinct. Hot bins
are left to adaptive skew handling; sides are broadcast by Spark's own size checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.intervals import any_region, overlaps, truncated_div

Interval = tuple[str, str, str]
DEFAULT: Interval = ("contigName", "start", "end")
#: Regions up to this number become literal tests that reach the scan; more are joined.
PUSHDOWN_LIMIT = 25


def with_bins(df: DataFrame, size: int, on: Interval = DEFAULT, name: str = "binId") -> DataFrame:
    """A row for each bin that the interval touches; rows with a null end point have none, nor have those whose last point
    lies in an earlier bin than their first."""
    _, start, end = on
    first = truncated_div(start, size)
    last = truncated_div(F.col(end) - 1, size)
    return df.where(last >= first).withColumn(name, F.explode(F.sequence(first, last)))


#: Levels of bins, and how many times wider each is than the one before.
LEVELS, FACTOR = 10, 8


def level_of(start: Column | str, end: Column | str, size: int) -> Column:
    """The lowest level whose bins are as long as the interval (a point if it has no length)."""
    length = F.greatest(F.col(end) - F.col(start) if isinstance(start, str) else end - start, F.lit(1))
    return sum((F.when(length > size * FACTOR**k, 1).otherwise(0) for k in range(LEVELS - 1)), F.lit(0))


def levels_there(left: DataFrame, right: DataFrame, left_on: Interval, right_on: Interval, size: int) -> tuple[list[int], list[int]]:
    """The levels that intervals of each side live in, in one pass over their ends."""
    of = lambda df, on, side: df.where(F.col(on[1]).isNotNull() & F.col(on[2]).isNotNull()).select(F.lit(side).alias("side"), level_of(on[1], on[2], size).alias("level"))
    found = of(left, left_on, 0).unionByName(of(right, right_on, 1)).distinct().collect()  # at most twice LEVELS rows
    return sorted(r.level for r in found if r.side == 0), sorted(r.level for r in found if r.side == 1)


def in_levels(df: DataFrame, on: Interval, size: int, own: list[int], others: list[int], first: bool) -> DataFrame:
    """A row for each bin that an interval is in or visits: _kind (of the meeting), _width and _bin. Pairs meet at the level of the
    longer one: kind k where that is the first side's level k, LEVELS + k where it is the second side's alone."""
    _, start, end = on
    last = F.greatest(F.col(end) - 1, F.col(start))
    at = lambda kind, k: F.struct(F.lit(kind).alias("kind"), F.lit(size * FACTOR**k).alias("width"))
    level = level_of(start, end, size)
    meets: list[Column] = []
    for k in range(LEVELS):
        if first:
            meets += [F.when(level == k, at(k, k))] if k in own and any(o <= k for o in others) else []
            meets += [F.when(level < k, at(LEVELS + k, k))] if k in others and any(o < k for o in own) else []
        else:
            meets += [F.when(level <= k, at(k, k))] if k in others and any(o <= k for o in own) else []
            meets += [F.when(level == k, at(LEVELS + k, k))] if k in own and any(o < k for o in others) else []
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    if own == others and len(own) == 1:  # one level, one kind of row
        width = size * FACTOR ** own[0]
        rows = rows.withColumn("_kind", F.lit(own[0])).withColumn("_width", F.lit(width))
        return rows.withColumn("_bin", F.explode(F.sequence(truncated_div(start, width), truncated_div(last, width))))
    rows = rows.withColumn("_m", F.explode(F.array_compact(F.array(*meets)) if meets else F.array().cast("array<struct<kind:int,width:bigint>>")))
    rows = rows.withColumn("_kind", F.col("_m.kind")).withColumn("_width", F.col("_m.width").cast("long")).drop("_m")
    return rows.withColumn("_bin", F.explode(F.sequence(truncated_div(start, F.col("_width")), truncated_div(last, F.col("_width")))))


def overlap_pairs(left: DataFrame, right: DataFrame, left_on: Interval, right_on: Interval, size: int = 1000) -> DataFrame:
    """Inner join of all columns (which must differ in name) on overlap. Bins of the lowest level are `size` wide."""
    lc, ls, le = left_on
    rc, rs, re = right_on
    left_levels, right_levels = levels_there(left, right, left_on, right_on, size)
    a = in_levels(left, left_on, size, left_levels, right_levels, True).withColumnsRenamed({"_kind": "_kind_l", "_bin": "_bin_l"})
    b = in_levels(right, right_on, size, right_levels, left_levels, False).withColumnsRenamed({"_kind": "_kind_r", "_bin": "_bin_r"}).drop("_width")
    first_shared = F.greatest(truncated_div(ls, F.col("_width")), truncated_div(rs, F.col("_width")))
    on = (F.col(lc) == F.col(rc)) & (F.col("_kind_l") == F.col("_kind_r")) & (F.col("_bin_l") == F.col("_bin_r")) & overlaps(ls, le, rs, re) & (F.col("_bin_l") == first_shared)
    return a.join(b, on).drop("_bin_l", "_bin_r", "_kind_l", "_kind_r", "_width")


def overlap_totals(intervals: DataFrame, regions: DataFrame, on: Interval = DEFAULT, regions_on: Interval = DEFAULT) -> DataFrame:
    """Each region with `n`, how many intervals overlap it, and `covered`, their common points added up; those without any are
    left out, as are intervals and regions that end before they start. No pair is formed: of the intervals that start before a
    region's end all overlap it but those that end by its start, and both are running sums over end points, so the work
    grows with rows and not with overlaps."""
    c, s, e = on
    rc, rs, re = regions_on
    zero, empty = F.lit(0).cast("long"), (F.col(s) == F.col(e)).cast("long")
    at = lambda x, begun, done, first, last, none, asked: F.struct(*(v.cast("long").alias(n) for v, n in zip((x, begun, done, first, last, none, asked), names, strict=True)))
    names = ("_at", "_begun", "_done", "_from", "_to", "_none", "_asked")
    ends = intervals.where(F.col(s) <= F.col(e)).select(F.col(c).alias("_c"), F.explode(F.array(at(F.col(s), F.lit(1), zero, F.col(s), zero, zero, zero), at(F.col(e), zero, F.lit(1), zero, F.col(e), empty, zero))).alias("_m"))
    asked = regions.where(F.col(rs) <= F.col(re)).select(F.col(rc).alias("_c"), F.explode(F.array(*(at(F.col(x), zero, zero, zero, zero, zero, F.lit(1)) for x in (rs, re)))).alias("_m"))
    steps = ends.unionByName(asked).where("_c is not null").select("_c", "_m.*").groupBy("_c", "_at").agg(*(F.sum(n).alias(n) for n in names[1:]))
    swept = running(steps, ["_c"], ["_at"], sums={f"{n}_sum": n for n in ("_begun", "_done", "_from", "_to")}).where("_asked > 0")
    before = F.col("_begun_sum") - F.col("_begun")  # intervals that start before the point, and those that end by it
    reach = F.col("_to_sum") + F.col("_at") * (before - F.col("_done_sum")) - (F.col("_from_sum") - F.col("_from"))  # their points before it
    known = swept.select("_c", "_at", before.alias("_before"), F.col("_done_sum").alias("_ended"), reach.alias("_reach"), "_none")
    side = lambda k: known.select(F.col("_c").alias(f"_c{k}"), *(F.col(n).alias(f"{n}{k}") for n in ("_at", "_before", "_ended", "_reach", "_none")))
    here = lambda k, x: (F.col(rc) == F.col(f"_c{k}")) & (F.col(x) == F.col(f"_at{k}"))
    both = regions.where(F.col(rs) <= F.col(re)).join(side(0), here(0, rs)).join(side(1), here(1, re))
    # an empty interval at an empty region has ended there without having begun before it
    n = F.col("_before1") - F.col("_ended0") + F.when(F.col(rs) == F.col(re), F.col("_none0")).otherwise(0)
    return both.select(*regions.columns, n.alias("n"), (F.col("_reach1") - F.col("_reach0")).alias("covered")).where("n > 0")


def _apart(regions: DataFrame, on: Interval) -> tuple[DataFrame, Interval]:
    names = ("_r_contig", "_r_start", "_r_end")
    return regions.select(*(F.col(c).alias(n) for c, n in zip(on, names, strict=True))), names


def overlap_semi(rows: DataFrame, regions: DataFrame, on: Interval = DEFAULT, regions_on: Interval = DEFAULT, size: int = 1000) -> DataFrame:
    """Rows that overlap a region, each once, identical rows kept. Regions are merged to disjoint ones first, so a row's
    hits are ordered; it is kept at the first, the one whose predecessor ends at or before the row's start."""
    regions, right_on = _apart(regions, regions_on)
    merged = merge(regions, right_on, adjoining=False)
    _, s, _ = on
    return overlap_pairs(rows, merged, on, right_on, size).where(F.col("_before") <= F.col(s)).select(*rows.columns)


#: Width of the bins in which running values are computed; a contig is many of them, so no task has to hold a whole one.
RUN_BIN = 1_000_000


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str] | None = None, most: dict[str, str] | None = None, last: dict[str, str] | None = None, following: dict[str, str] | None = None, size: int | None = None) -> DataFrame:
    """Running values over `rows` of each `keys` in `order` (its first a position), bin by bin: a column of sums up to and
    with the row, of the most, and of the last value among the rows before it, and of the value in the following row; each
    dict maps a new column to the one it comes from. Bins are ranked apart; one row a bin carries values across them."""
    sums, most, last, following = sums or {}, most or {}, last or {}, following or {}
    binned = rows.withColumn("_bin", F.floor(F.col(order[0]) / (size or RUN_BIN)).cast("long"))
    own, over = Window.partitionBy(*keys, "_bin").orderBy(*order), Window.partitionBy(*keys).orderBy("_bin")
    earlier, place = own.rowsBetween(Window.unboundedPreceding, -1), F.struct(*order)
    totals = binned.groupBy(*keys, "_bin").agg(
        *(F.sum(c).alias(n) for n, c in sums.items()), *(F.max(c).alias(n) for n, c in most.items()),
        *(F.max_by(F.struct(c), place)[c].alias(n) for n, c in last.items()), *(F.min_by(F.struct(c), place)[c].alias(n) for n, c in following.items()), F.count("*").alias("_rows"),
    )
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "_bin", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_c_{n}") for n in sums), *(F.max(n).over(before).alias(f"_c_{n}") for n in most),
        *(F.lag(n).over(over).alias(f"_c_{n}") for n in last), *(F.lead(n).over(over).alias(f"_c_{n}") for n in following),
    )
    inside = binned.select(
        "*", *(F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_i_{n}") for n, c in sums.items()), *(F.max(c).over(earlier).alias(f"_i_{n}") for n, c in most.items()),
        *(F.lag(F.struct(c)).over(own).alias(f"_i_{n}") for n, c in last.items()), *(F.lead(F.struct(c)).over(own).alias(f"_i_{n}") for n, c in following.items()),
    )
    same = F.lit(True)
    for c in (*keys, "_bin"):
        same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    both = inside.alias("x").join(carried.alias("y"), same)
    whole = lambda n, c: F.when(F.col(f"_i_{n}").isNotNull(), F.col(f"_i_{n}")[c]).otherwise(F.col(f"_c_{n}"))
    return both.select(
        *(F.col(f"x.{c}") for c in rows.columns), *((F.col(f"_i_{n}") + F.col(f"_c_{n}")).alias(n) for n in sums), *(F.greatest(F.col(f"_i_{n}"), F.col(f"_c_{n}")).alias(n) for n in most),
        *(whole(n, c).alias(n) for n, c in (*last.items(), *following.items())),
    )


def merge(regions: DataFrame, on: Interval = DEFAULT, adjoining: bool = True) -> DataFrame:
    """Disjoint regions that cover the same points (with `adjoining` those that touch are joined too), with `_before`: the
    end of the previous."""
    c, s, e = on
    # equal regions are one, so a region's place in the order is its own
    seen = running(regions.where(F.col(s) <= F.col(e)).select(*on).distinct(), [c], [s, e], most={"_reach": e})
    apart = ~((F.col("_reach") >= F.col(s)) if adjoining else (F.col("_reach") > F.col(s)))
    marked = running(seen.withColumn("_new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)), [c], [s, e], sums={"_island": "_new"})
    out = marked.groupBy(c, "_island").agg(F.min(s).alias(s), F.max(e).alias(e), F.min_by(F.struct("_reach"), F.struct(s, e))["_reach"].alias("_before"))
    return out.withColumn("_before", F.coalesce("_before", F.lit(-(1 << 62)))).drop("_island")


def overlap_semi_distinct(rows: DataFrame, regions: DataFrame, on: Interval = DEFAULT, regions_on: Interval = DEFAULT, size: int = 1000) -> DataFrame:
    """Rows that overlap a region; identical rows become one."""
    return overlap_semi(rows, regions, on, regions_on, size).dropDuplicates()


def region_filter(rows: DataFrame, regions: Sequence[tuple[str, int, int]], on: Interval = DEFAULT, keys: Sequence[str] | None = None, limit: int = PUSHDOWN_LIMIT, size: int = 1000) -> DataFrame:
    """Rows that overlap one of the regions, with the same columns either way: few regions as one pushed-down test, more
    as a join, after which rows equal in `keys` (all columns by default) become one."""
    if len(regions) <= limit:
        return rows.where(any_region(*on, list(regions)))
    table = rows.sparkSession.createDataFrame(list(regions), "contigName string, start long, end long")
    return region_join(rows, table, on, keys, size)


def region_join(rows: DataFrame, regions: DataFrame, on: Interval = DEFAULT, keys: Sequence[str] | None = None, size: int = 1000, regions_on: Interval = DEFAULT) -> DataFrame:
    found = overlap_semi(rows, regions, on, regions_on, size)
    return found.dropDuplicates(list(keys) if keys else None)


def masked_sites(sites: DataFrame, regions: DataFrame, site_on: tuple[str, str] = ("contigName", "pos"), regions_on: Interval = DEFAULT, size: int = 1000) -> DataFrame:
    """Pairs of a region and a point inside it."""
    contig, pos = site_on
    points = sites.withColumn("_p_end", F.col(pos) + 1)
    return overlap_pairs(points, regions, (contig, pos, "_p_end"), regions_on, size).drop("_p_end")


def trim_to_targets(rows: DataFrame, targets: DataFrame, on: Interval = DEFAULT, targets_on: Interval = DEFAULT, size: int = 1000) -> DataFrame:
    """Each interval cut to each target that it overlaps."""
    t, right_on = _apart(targets, targets_on)
    _, s, e = on
    both = overlap_pairs(rows, t, on, right_on, size)
    return both.withColumn(s, F.greatest(s, "_r_start")).withColumn(e, F.least(e, "_r_end")).drop(*right_on)


def subtract(targets: DataFrame, exclusions: DataFrame, on: Interval = DEFAULT) -> DataFrame:
    """The points of `targets` that no exclusion covers, as disjoint intervals: a sweep over both sides' end points."""
    c, s, e = on
    ends = lambda df, t, x: df.where(F.col(s) < F.col(e)).select(F.col(c).alias("c"), F.explode(F.array(F.struct(F.col(s).alias("at"), F.lit(t).alias("t"), F.lit(x).alias("x")), F.struct(F.col(e).alias("at"), F.lit(-t).alias("t"), F.lit(-x).alias("x")))).alias("m")).select("c", "m.*")
    steps = ends(targets, 1, 0).unionByName(ends(exclusions, 0, 1)).groupBy("c", "at").agg(F.sum("t").alias("t"), F.sum("x").alias("x"))
    swept = running(steps, ["c"], ["at"], sums={"run_t": "t", "run_x": "x"}, following={"next": "at"})
    kept = swept.where("run_t > 0 and run_x = 0 and next is not null").select(F.col("c").alias(c), F.col("at").alias(s), F.col("next").alias(e))
    return merge(kept, on).select(c, s, e)


def trim_bins(rows: DataFrame, lengths: DataFrame, bin_start: Column | str = "binStart", contig: str = "contigName") -> DataFrame:
    """Drop bins that begin at or beyond the contig's end; `lengths` has contigName and length. Unknown contigs go."""
    at = F.col(bin_start) if isinstance(bin_start, str) else bin_start
    known = lengths.select(F.col("contigName").alias("_contig"), F.col("length").alias("_length"))
    return rows.join(known, F.col(contig) == F.col("_contig")).where(at < F.col("_length")).drop("_contig", "_length")
