"""Catalogue of the engine's own queries with their SQL. Each query runs an operator over whole projected tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import genotypes, intervals as fi, sequence, sql
from helixframe.operators import assembly, expression, reads as ro, variants as vo
from helixframe.operators import intervals as oi
from helixframe.plans.inputs import FEATURES, READS, REGIONS, VARIANTS, features, reads, regions, table, variants
from helixframe.sources import manifest

READ_ON = ("referenceName", "start", "end")
QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {READS}, b AS (SELECT referenceName, s, unnest(range(s // 100, (e - 1) // 100 + 1)) AS bin_id, (e - 1) // 100 AS last FROM reads WHERE e > s)
SELECT referenceName, CAST(bin_id AS INTEGER) AS bin_id, count(*) AS n, count(*) FILTER (bin_id = last) AS n_last, count(*) FILTER (s < bin_id * 100) AS n_duplicate FROM b GROUP BY 1, 2""")
def interval_bins(spark: SparkSession, d: str) -> DataFrame:
    b = reads(spark, d).select("referenceName", "start", F.explode(fi.bins("start", "end", 100)).alias("b")).select("referenceName", "start", "b.*")
    return b.groupBy("referenceName", F.col("binId").alias("bin_id")).agg(F.count("*").alias("n"), F.count(F.when(F.col("isLastBin"), 1)).alias("n_last"), F.count(F.when(fi.is_duplicate_bin("start", "binId", 100), 1)).alias("n_duplicate"))


@query(f"""WITH {READS}, b AS (SELECT referenceName, s, unnest(range(s // 100, (e - 1) // 100 + 1)) AS bin_id, (e - 1) // 100 AS last FROM reads WHERE e > s)
SELECT referenceName, CAST(bin_id AS INTEGER) AS bin_id, count(*) AS n, count(*) FILTER (bin_id = last) AS n_last FROM b GROUP BY 1, 2""")
def lateral_bins(spark: SparkSession, d: str) -> DataFrame:
    """The table function of bins in SQL text."""
    sql.register(spark)
    return spark.sql("SELECT referenceName, b.binId AS bin_id, count(*) AS n, count_if(b.isLastBin) AS n_last FROM {reads} AS r, LATERAL bins_of(r.start, r.end, 100L) AS b GROUP BY ALL", reads=reads(spark, d))


@query(f"WITH {READS}, {REGIONS} SELECT region_id, contig, count(*) AS n FROM regions JOIN reads ON contig = referenceName AND s < re AND e > rs GROUP BY 1, 2")
def overlap_join_count(spark: SparkSession, d: str) -> DataFrame:
    r = regions(spark, d).select(F.col("contigName").alias("contig"), F.col("start").alias("rs"), F.col("end").alias("re"), "region_id")
    pairs = oi.overlap_pairs(reads(spark, d).select(*READ_ON), r, READ_ON, ("contig", "rs", "re"))
    return pairs.groupBy("region_id", "contig").agg(F.count("*").alias("n"))


LONG_SQL = """WITH g AS (SELECT s_suppkey AS region_id, concat('chr', CAST(s_suppkey % 3 AS VARCHAR)) AS contig, s_suppkey * 3001 % 900000 AS rs, s_suppkey * 3001 % 900000 + CAST(power(10, s_suppkey % 8) AS BIGINT) AS re FROM supplier),
r AS (SELECT concat('chr', CAST(o_custkey % 3 AS VARCHAR)) AS c, o_orderkey * 10 AS s, o_orderkey * 10 + CAST(power(7, o_custkey % 6) AS BIGINT) AS e FROM orders)"""


@query(LONG_SQL + " SELECT region_id, contig, count(*) AS n, CAST(sum(least(e, re) - greatest(s, rs)) AS BIGINT) AS covered FROM g JOIN r ON contig = c AND s < re AND e > rs GROUP BY 1, 2")
def mixed_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Regions of 1 to 10,000,000 places against intervals of 1 to 16,807. Pairs grow with the product of both tables, so they are
    counted from end points and not formed."""
    k, n = F.col("s_suppkey"), F.col("o_custkey")
    contig = lambda x: F.concat(F.lit("chr"), (x % 3).cast("string"))
    g = table(spark, d, "supplier").select(k.alias("region_id"), contig(k).alias("contig"), (k * 3001 % 900_000).alias("rs")).withColumn("re", F.col("rs") + F.pow(F.lit(10), F.col("region_id") % 8).cast("long"))
    r = table(spark, d, "orders").select(contig(n).alias("c"), (F.col("o_orderkey") * 10).alias("s"), F.pow(F.lit(7), n % 6).cast("long").alias("length"))
    totals = oi.overlap_totals(r.select("c", "s", (F.col("s") + F.col("length")).alias("e")), g, ("c", "s", "e"), ("contig", "rs", "re"))
    return totals.groupBy("region_id", "contig").agg(F.sum("n").alias("n"), F.sum("covered").alias("covered"))


@query(f"WITH {READS}, {REGIONS} SELECT DISTINCT referenceName, s AS start_pos, e AS end_pos, mappingQuality FROM reads WHERE EXISTS (SELECT 1 FROM regions WHERE contig = referenceName AND s < re AND e > rs)")
def overlap_semi_distinct(spark: SparkSession, d: str) -> DataFrame:
    rows = reads(spark, d).select(*READ_ON, "mappingQuality")
    return oi.overlap_semi_distinct(rows, regions(spark, d), READ_ON).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


@query(f"WITH {READS}, {REGIONS} SELECT referenceName, s AS start_pos, e AS end_pos, part FROM reads WHERE EXISTS (SELECT 1 FROM regions WHERE contig = referenceName AND s < re AND e > rs)")
def overlap_left_semi(spark: SparkSession, d: str) -> DataFrame:
    return oi.overlap_semi(reads(spark, d).select(*READ_ON, "part"), regions(spark, d), READ_ON).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


LITERAL_REGIONS = [("chr0", 1000, 1100), ("chr1", 5000, 5500), ("chr4", 20000, 26000)]


@query(f"""WITH {READS} SELECT referenceName, s AS start_pos, e AS end_pos, part FROM reads WHERE (referenceName = 'chr0' AND s < 1100 AND e > 1000)
  OR (referenceName = 'chr1' AND s < 5500 AND e > 5000) OR (referenceName = 'chr4' AND s < 26000 AND e > 20000)""")
def region_or_filter(spark: SparkSession, d: str) -> DataFrame:
    return oi.region_filter(reads(spark, d).select(*READ_ON, "part"), LITERAL_REGIONS, READ_ON).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


@query(f"""WITH {VARIANTS}, {REGIONS}, g AS (SELECT contigName AS c, rs % 7000 AS gs, rs % 7000 + 25 AS ge FROM (SELECT concat('chr', CAST(region_id % 3 AS VARCHAR)) AS contigName, rs FROM regions))
SELECT contigName, s AS start_pos, e AS end_pos, sampleId, max(key) AS key FROM variants WHERE EXISTS (SELECT 1 FROM g WHERE c = contigName AND s < ge AND e > gs) GROUP BY ALL""")
def region_broadcast_join(spark: SparkSession, d: str) -> DataFrame:
    g = regions(spark, d).select(F.concat(F.lit("chr"), (F.col("region_id") % 3).cast("string")).alias("contigName"), (F.col("start") % 7000).alias("start")).withColumn("end", F.col("start") + 25)
    rows = variants(spark, d).groupBy("contigName", "start", "end", "sampleId").agg(F.max("key").alias("key"))
    return oi.region_join(rows, g, keys=["contigName", "start", "end", "sampleId"]).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


@query(f"WITH {READS} SELECT referenceName, s AS start_pos, e AS end_pos, mappingQuality, part FROM reads WHERE mappingQuality >= 20 AND readMapped AND NOT secondaryAlignment AND NOT duplicateRead AND NOT failedVendorQualityChecks")
def read_quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return ro.quality_filter(reads(spark, d)).select("referenceName", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "mappingQuality", "part")


@query(f"""WITH {READS}, {FEATURES}, c AS (SELECT transcriptId, count(*) AS n FROM exons JOIN reads ON contig = referenceName AND s < fe AND e > fs GROUP BY 1)
SELECT contig AS referenceName, transcriptId, ts AS start_pos, ts + 27 AS end_pos, coalesce(CAST(n AS DOUBLE), 0.0) AS score, 'sample1' AS source FROM tx LEFT JOIN c USING (transcriptId)""")
def transcript_counts(spark: SparkSession, d: str) -> DataFrame:
    f = features(spark, d)
    counts = expression.count_reads(f, reads(spark, d))
    return expression.score_transcripts(f, counts, "sample1").select("referenceName", "transcriptId", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "score", "source")


@query(f"""WITH {VARIANTS}, p AS (SELECT DISTINCT contigName AS c, s AS ps FROM variants WHERE cust % 6 = 0)
SELECT contigName, s AS start_pos, e AS end_pos, sampleId, key FROM variants WHERE NOT EXISTS (SELECT 1 FROM p WHERE c = contigName AND ps = s)""")
def panel_of_normals(spark: SparkSession, d: str) -> DataFrame:
    v = variants(spark, d)
    return vo.panel_of_normals(v, v.where("cust % 6 = 0")).select("contigName", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "sampleId", "key")


@query("""WITH k AS (SELECT l_linestatus AS library, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_suppkey % 40 END AS l, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_partkey % 5 END AS r,
  CAST(l_quantity AS INTEGER) AS score, concat(CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR)) AS name FROM lineitem),
k2 AS (SELECT DISTINCT * FROM k), u AS (SELECT name, max(score) AS score, any_value(library) AS library, any_value(l) AS l, any_value(r) AS r FROM k2 GROUP BY name),
p AS (SELECT library, l, count(r) > 0 AS has_pair FROM u GROUP BY 1, 2),
b AS (SELECT library, l, r, max(score) AS best FROM u GROUP BY 1, 2, 3),
w AS (SELECT u.library, u.l, u.r, min(name) AS winner FROM u JOIN b ON u.library = b.library AND u.l = b.l AND u.r IS NOT DISTINCT FROM b.r AND u.score = b.best GROUP BY 1, 2, 3)
SELECT u.name, coalesce(u.l IS NOT NULL AND ((u.r IS NULL AND p.has_pair) OR u.name <> w.winner), false) AS primary_dup, u.l IS NOT NULL AS secondary_dup
FROM u LEFT JOIN p ON u.library = p.library AND u.l = p.l LEFT JOIN w ON u.library = w.library AND u.l = w.l AND u.r IS NOT DISTINCT FROM w.r""")
def mark_duplicates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem")
    name = F.concat_ws("_", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    left = F.when(F.col("l_partkey") % 13 != 0, F.struct(F.lit("c").alias("referenceName"), (F.col("l_suppkey") % 40).alias("pos")))
    right = F.when(F.col("l_linenumber") % 2 != 0, F.struct(F.lit("c").alias("referenceName"), (F.col("l_partkey") % 5).alias("pos")))
    k = t.select(F.col("l_linestatus").alias("library"), left.alias("left"), right.alias("right"), F.col("l_quantity").cast("int").alias("score"), name.alias("name"))
    u = k.groupBy("name").agg(F.max("score").alias("score"), F.first("library").alias("library"), F.first("left").alias("left"), F.first("right").alias("right"))
    return ro.duplicate_flags(u).select("name", F.col("primaryDup").alias("primary_dup"), F.col("secondaryDup").alias("secondary_dup"))


@query(f"""WITH t AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS rg, l_linestatus AS status, l_quantity, l_extendedprice FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY rg, l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, status) - 1 AS k, concat('chr', CAST(l_suppkey % 2 AS VARCHAR)) AS c, l_partkey % 30 * 5 AS s, CAST(l_quantity AS BIGINT) % 4 + 6 AS len, l_partkey % 3 * 2 AS lead, l_suppkey % 3 AS tail, l_linenumber % 2 = 0 AS neg FROM t),
a AS (SELECT rg, l_orderkey, k, {"{'c': c, 'p': CASE WHEN neg THEN s + len + tail ELSE greatest(s - lead, 0) END, 'o': CASE WHEN neg THEN 'REVERSE' ELSE 'FORWARD' END}"} AS pos, neg, 30 * len AS score FROM n WHERE k < 2),
f AS (SELECT rg, l_orderkey, max(CASE WHEN k = 0 THEN pos END) AS a0, max(CASE WHEN k = 1 THEN pos END) AS a1, CAST(sum(score) AS INTEGER) AS score FROM a GROUP BY ALL),
p AS (SELECT rg, l_orderkey, score, CASE WHEN a0.o = 'FORWARD' THEN a0 WHEN a1.o = 'FORWARD' THEN a1 ELSE a0 END AS l, CASE WHEN a1.o = 'REVERSE' THEN a1 WHEN a0.o = 'REVERSE' THEN a0 ELSE a1 END AS r, CASE WHEN rg = 'A' THEN 'one' WHEN rg = 'N' THEN 'two' END AS lib FROM f),
w AS (SELECT *, row_number() OVER (PARTITION BY lib, l, r ORDER BY score DESC, CAST(l_orderkey AS VARCHAR), rg) AS rn, max(CASE WHEN r IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY lib, l) AS pair FROM p)
SELECT rg AS read_group, CAST(l_orderkey AS VARCHAR) AS name, (r IS NULL AND pair = 1) OR rn > 1 AS duplicate FROM w""")
def duplicates_of_reads(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates from alignments: fragments of one or two reads by read group and name, their positions from starts, clips and
    strands, scores from qualities, libraries from read groups; names occur in several read groups."""
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice").distinct()
    nth = F.row_number().over(Window.partitionBy("l_returnflag", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus")) - 1
    start, size = F.col("l_partkey") % 30 * 5, F.col("l_quantity").cast("long") % 4 + 6
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    r = t.withColumn("readInFragment", nth).where("readInFragment < 2").select(
        F.col("l_orderkey").cast("string").alias("readName"), F.col("l_returnflag").alias("readGroupId"), "readInFragment", F.concat(F.lit("chr"), (F.col("l_suppkey") % 2).cast("string")).alias("referenceName"), start.alias("start"), (start + size).alias("end"),
        (F.col("l_linenumber") % 2 == 0).alias("readNegativeStrand"), F.concat(clip(F.col("l_partkey") % 3 * 2), size.cast("string"), F.lit("M"), clip(F.col("l_suppkey") % 3)).alias("cigar"), F.repeat(F.lit("?"), size.cast("int")).alias("qualityScores"), F.repeat(F.lit("A"), size.cast("int")).alias("sequence"),
        F.lit(True).alias("readMapped"), F.lit(True).alias("primaryAlignment"), F.lit(False).alias("supplementaryAlignment"), F.lit(False).alias("duplicateRead"), F.lit(None).cast("long").alias("insertSize"),
    )
    libraries = t.select(F.col("l_returnflag").alias("readGroupId"), F.when(F.col("l_returnflag") == "A", "one").when(F.col("l_returnflag") == "N", "two").alias("library")).distinct()
    marked = ro.mark_duplicates(ro.to_fragments(r), libraries)
    return marked.select(F.col("readGroupId").alias("read_group"), "name", F.col("alignments")[0]["duplicateRead"].alias("duplicate"))


@query("""WITH q AS (SELECT doc_id, regexp_replace(text, '[^0-~]', '', 'g') AS q FROM documents)
SELECT doc_id, CAST(coalesce(list_sum(list_transform(string_split(nullif(q, ''), ''), lambda c: ord(c) - 33)), 0) AS INTEGER) AS score FROM q""")
def read_score(spark: SparkSession, d: str) -> DataFrame:
    """Of every document's whole text; characters outside the qualities '!' to '~' score 0, null and empty texts 0."""
    t = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[^!-~]", "!").alias("q"))
    return t.select("doc_id", F.coalesce(sequence.read_score("q"), F.lit(0)).alias("score"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(list_transform([l_partkey % 60, l_suppkey % 60, l_orderkey % 60, l_linenumber],
  lambda q: chr(CAST(33 + CASE WHEN q < 2 THEN 1 WHEN q < 7 THEN q WHEN q < 16 THEN 10 WHEN q < 26 THEN 20 ELSE 30 END AS INTEGER))), '') AS binned FROM lineitem""")
def quality_binning(spark: SparkSession, d: str) -> DataFrame:
    ch = lambda c: F.char(F.col(c) % 60 + 33) if c != "l_linenumber" else F.char(F.col(c) + 33)
    q = F.concat(*map(ch, ("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sequence.bin_qualities(q).alias("binned"))


@query("SELECT p_partkey, translate(p_name, 'abcde', 'vwxyz') AS mapped FROM part")
def string_map(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", sequence.map_characters("p_name", dict(zip("abcde", "vwxyz", strict=True))).alias("mapped"))


@query("""WITH r AS (SELECT DISTINCT concat('f', CAST(l_orderkey AS VARCHAR)) AS readName, l_partkey % 2 AS num, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS o FROM lineitem),
c AS (SELECT readName, count(*) FILTER (num = 0) AS z, count(*) FILTER (num = 1) AS f, max(o) FILTER (num = 0) AS last0, min(o) FILTER (num = 1) AS first1 FROM r GROUP BY 1)
SELECT r.readName, CAST(r.num AS BIGINT) AS number, r.o AS ordinal FROM r JOIN c USING (readName) WHERE z % 2 = 1 AND f >= 1 AND ((num = 0 AND o = last0) OR (num = 1 AND o = first1))""")
def pair_reads(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").select(F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("readName"), (F.col("l_partkey") % 2).alias("number"), (F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("ordinal")).distinct()
    return ro.pair_reads(t, "readName", "number", "ordinal")


CIGAR_SQL = "concat(CASE WHEN l_partkey % 3 = 0 THEN concat(CAST(l_partkey % 9 + 1 AS VARCHAR), 'H') ELSE '' END, CASE WHEN l_suppkey % 2 = 0 THEN '4S' ELSE '' END, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 'M', CASE WHEN l_linenumber > 3 THEN concat(CAST(l_linenumber AS VARCHAR), 'S') ELSE '' END, CASE WHEN l_partkey % 7 = 0 THEN '2H' ELSE '' END)"


def _cigars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + F.col("l_quantity").cast("int")).alias("end"), (F.col("l_returnflag") == "R").alias("neg"), F.concat(F.when(F.col("l_partkey") % 3 == 0, F.concat((F.col("l_partkey") % 9 + 1).cast("string"), F.lit("H"))).otherwise(""), F.when(F.col("l_suppkey") % 2 == 0, "4S").otherwise(""), F.col("l_quantity").cast("int").cast("string"), F.lit("M"), F.when(F.col("l_linenumber") > 3, F.concat(F.col("l_linenumber").cast("string"), F.lit("S"))).otherwise(""), F.when(F.col("l_partkey") % 7 == 0, "2H").otherwise("")).alias("cigar"))


@query("""WITH c AS (SELECT *, (CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 9 + 1 ELSE 0 END) + (CASE WHEN l_suppkey % 2 = 0 THEN 4 ELSE 0 END) AS lead, (CASE WHEN l_linenumber > 3 THEN l_linenumber ELSE 0 END) + (CASE WHEN l_partkey % 7 = 0 THEN 2 ELSE 0 END) AS tail FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_returnflag = 'R' THEN l_orderkey + CAST(l_quantity AS INTEGER) + tail ELSE greatest(l_orderkey - lead, 0) END AS BIGINT) AS pos FROM c""")
def five_prime(spark: SparkSession, d: str) -> DataFrame:
    return _cigars(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sequence.five_prime("start", "end", "cigar", "neg").alias("pos"))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, replace({CIGAR_SQL}, 'S', 'H') AS hard, CAST(CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 9 + 1 ELSE 0 END AS INTEGER) AS from_start,
  CAST(CASE WHEN l_partkey % 7 = 0 THEN 2 ELSE 0 END AS INTEGER) AS from_end, repeat('A', CAST(l_quantity AS INTEGER)) AS trimmed FROM lineitem""")
def trim_supplementary(spark: SparkSession, d: str) -> DataFrame:
    c = _cigars(spark, d)
    soft = F.regexp_replace("cigar", "[0-9]+H", "")
    bases = F.concat(F.when(F.col("l_suppkey") % 2 == 0, "GGGG").otherwise(""), F.expr("repeat('A', cast(`end` - start as int))"), F.when(F.col("l_linenumber") > 3, F.expr("repeat('C', l_linenumber)")).otherwise(""))
    clips = sequence.hard_clips("cigar")
    return c.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sequence.soft_to_hard("cigar").alias("hard"), clips["fromStart"].alias("from_start"), clips["fromEnd"].alias("from_end"), sequence.trim_supplementary(bases, soft).alias("trimmed"))


@query("SELECT p_partkey, reverse(translate(upper(p_name), 'ACGT', 'TGCA')) AS rc FROM part")
def revcomp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", sequence.reverse_complement(F.upper("p_name")).alias("rc"))


@query("""WITH f AS (SELECT o_orderkey, o_custkey % 4096 AS f FROM orders)
SELECT o_orderkey, f & 1 <> 0 AS read_paired, f & 2 <> 0 AS proper_pair, f & 4 = 0 AS read_mapped, f & 1 <> 0 AND f & 8 = 0 AS mate_mapped, f & 16 <> 0 AS negative, f & 32 <> 0 AS mate_negative, f & 256 <> 0 AS secondary,
  f & 512 <> 0 AS failed, f & 1024 <> 0 AS duplicate, f & 2048 <> 0 AS supplementary, f & 256 = 0 AND f & 2048 = 0 AS is_primary, CASE WHEN f & 128 <> 0 THEN 1 ELSE 0 END AS read_in_fragment FROM f""")
def flag_decode(spark: SparkSession, d: str) -> DataFrame:
    named = {"readPaired": "read_paired", "properPair": "proper_pair", "readMapped": "read_mapped", "mateMapped": "mate_mapped", "readNegativeStrand": "negative", "mateNegativeStrand": "mate_negative", "secondaryAlignment": "secondary", "failedVendorQualityChecks": "failed", "duplicateRead": "duplicate", "supplementaryAlignment": "supplementary", "primaryAlignment": "is_primary", "readInFragment": "read_in_fragment"}
    got = sequence.decode_flags(F.col("o_custkey") % 4096)
    return table(spark, d, "orders").select("o_orderkey", *(got[k].alias(v) for k, v in named.items()))


@query("""SELECT o_orderkey, o_custkey % 3 = 0 AS mapped, CASE WHEN o_custkey % 3 = 0 THEN concat('XS:i:', CAST(o_custkey % 50 AS VARCHAR), chr(9), 'AS:i:', CAST(o_custkey % 90 AS VARCHAR), chr(9), 'NM:i:', CAST(o_custkey % 5 AS VARCHAR), chr(9), 'RG:Z:', o_orderstatus)
  ELSE concat('XS:i:0', chr(9), 'AS:i:0', chr(9), 'RG:Z:', o_orderstatus) END AS attributes, o_orderstatus AS read_group FROM orders""")
def attributes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_custkey")
    t = table(spark, d, "orders").select("o_orderkey", (k % 3 == 0).alias("mapped"), sequence.attributes(k % 3 == 0, k % 50, k % 90, k % 5, "o_orderstatus").alias("attributes"))
    return t.withColumn("read_group", sequence.attribute("attributes", "RG"))


@query(f"""WITH {VARIANTS} SELECT contigName, s AS start_pos, sampleId, any_value(gq) AS gq, count(*) AS n FROM (SELECT contigName, s, sampleId, gq FROM variants UNION ALL SELECT contigName, s, sampleId, gq FROM variants WHERE cust % 2 = 0) GROUP BY contigName, s, sampleId, gq""")
def split_samples(spark: SparkSession, d: str) -> DataFrame:
    v = variants(spark, d)
    one = F.struct("sampleId", "gq")
    many = v.select("contigName", "start", F.when(F.col("cust") % 2 == 0, F.array(one, one)).otherwise(F.array(one)).alias("genotypes"))
    out = vo.split_samples(many).select("contigName", F.col("start").alias("start_pos"), F.col("genotypes")[0]["sampleId"].alias("sampleId"), F.col("genotypes")[0]["gq"].alias("gq"))
    return out.groupBy("contigName", "start_pos", "sampleId", "gq").agg(F.count("*").alias("n")).select("contigName", "start_pos", "sampleId", "gq", "n")


@query("""SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN true WHEN 1 THEN coalesce(o_custkey % 7 + 1 <= nullif(o_custkey % 30, 0), true) WHEN 2 THEN coalesce((o_custkey % 7 + 1) * (o_custkey % 7 + 2) // 2 <= nullif(o_custkey % 30, 0), true)
  ELSE coalesce((o_custkey % 7 + 1) * (o_custkey % 7 + 2) * (o_custkey % 7 + 3) // 6 <= nullif(o_custkey % 30, 0), true) END AS valid FROM orders""")
def pl_valid(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_custkey")
    return table(spark, d, "orders").select("o_orderkey", genotypes.has_valid_pls(k % 7, k % 4, k % 30, F.lit(0)).alias("valid"))


@query("SELECT DISTINCT o_custkey % 60 + 1 AS alleles, (o_custkey % 60 + 1) * (o_custkey % 60 + 2) // 2 AS diploid, (o_custkey % 60 + 1) * (o_custkey % 60 + 2) * (o_custkey % 60 + 3) // 6 AS triploid FROM orders")
def genotype_count(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("o_custkey") % 60 + 1
    return table(spark, d, "orders").select(n.alias("alleles"), genotypes.genotype_count(F.lit(2), n).alias("diploid"), genotypes.genotype_count(F.lit(3), n).alias("triploid")).distinct()


BOUNDS = [20, 60, 80]


@query(f"""WITH {VARIANTS}, one AS (SELECT contigName, s, min(gq) AS gq, min(depth) AS depth, min(pl2) AS pl2, max(CASE WHEN polymorphic THEN 1 ELSE 0 END) = 0 AS hom_ref, s + 7 AS e FROM variants GROUP BY contigName, s),
b AS (SELECT *, CASE WHEN NOT hom_ref THEN -1 WHEN gq >= 80 THEN 3 WHEN gq >= 60 THEN 2 WHEN gq >= 20 THEN 1 ELSE 0 END AS band FROM one),
c AS (SELECT *, CASE WHEN lag(band) OVER w = band AND lag(e) OVER w = s AND hom_ref THEN 0 ELSE 1 END AS new FROM b WINDOW w AS (PARTITION BY contigName ORDER BY s)),
i AS (SELECT *, sum(new) OVER (PARTITION BY contigName ORDER BY s) AS island FROM c)
SELECT contigName, min(s) AS start_pos, max(e) AS end_pos, min(depth) AS min_dp, min(pl2) AS pl2, count(*) AS sites, bool_and(hom_ref) AS hom_ref FROM i GROUP BY contigName, island""")
def gvcf_bands(spark: SparkSession, d: str) -> DataFrame:
    one = variants(spark, d).groupBy("contigName", "start").agg(F.min("gq").alias("gq"), F.min("depth").alias("depth"), F.min("pl2").alias("pl2"), (~F.max("polymorphic")).alias("homRef")).withColumn("end", F.col("start") + 7)
    return vo.islands(one, BOUNDS).groupBy("contigName", "island").agg(F.min("start").alias("start_pos"), F.max("end").alias("end_pos"), F.min("depth").alias("min_dp"), F.min("pl2").alias("pl2"), F.count("*").alias("sites"), F.bool_and("homRef").alias("hom_ref")).drop("island")


@query(f"WITH {VARIANTS}, r AS (SELECT contigName, row_number() OVER (ORDER BY contigName, s, key) - 1 AS i FROM variants) SELECT contigName, min(i) AS first_index, max(i) AS last_index FROM r GROUP BY 1")
def snp_table_index(spark: SparkSession, d: str) -> DataFrame:
    return vo.snp_index(variants(spark, d)).withColumnsRenamed({"first": "first_index", "last": "last_index"})


@query(f"WITH {READS}, {REGIONS}, p AS (SELECT DISTINCT referenceName AS c, s AS pos FROM reads) SELECT region_id, contig, pos FROM p JOIN regions ON c = contig AND pos >= rs AND pos < re")
def masked_sites(spark: SparkSession, d: str) -> DataFrame:
    sites = reads(spark, d).select(F.col("referenceName").alias("c"), F.col("start").alias("pos")).distinct()
    r = regions(spark, d).select(F.col("contigName").alias("contig"), F.col("start").alias("rs"), F.col("end").alias("re"), "region_id")
    return oi.masked_sites(sites, r, ("c", "pos"), ("contig", "rs", "re")).select("region_id", "contig", "pos")


@query(f"WITH {READS}, {REGIONS} SELECT referenceName, part, greatest(s, rs) AS start_pos, least(e, re) AS end_pos FROM reads JOIN regions ON contig = referenceName AND s < re AND e > rs")
def interval_trim(spark: SparkSession, d: str) -> DataFrame:
    return oi.trim_to_targets(reads(spark, d).select(*READ_ON, "part"), regions(spark, d), READ_ON).select("referenceName", "part", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


@query("""WITH t AS (SELECT concat('chr', CAST(o_custkey % 3 AS VARCHAR)) AS c, o_orderkey AS p FROM orders), x AS (SELECT concat('chr', CAST(o_custkey % 3 AS VARCHAR)) AS c, o_orderkey AS p FROM orders),
a AS (SELECT DISTINCT c, unnest(range(p, p + 9)) AS p FROM t), b AS (SELECT DISTINCT c, unnest(range(p, p + 4)) AS p FROM x), k AS (SELECT * FROM a EXCEPT SELECT * FROM b),
g AS (SELECT c, p, p - row_number() OVER (PARTITION BY c ORDER BY p) AS island FROM k) SELECT c AS contig, min(p) AS start_pos, max(p) + 1 AS end_pos FROM g GROUP BY c, island""")
def interval_subtract(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.concat(F.lit("chr"), (F.col("o_custkey") % 3).cast("string")).alias("contigName"), F.col("o_orderkey").alias("start"))
    t = o.withColumn("end", F.col("start") + 9)
    x = o.withColumn("end", F.col("start") + 4)
    return oi.subtract(t, x).withColumnsRenamed({"contigName": "contig", "start": "start_pos", "end": "end_pos"})


@query(f"WITH {VARIANTS} SELECT contigName, s + 1 AS pos, key FROM variants WHERE s + 1 BETWEEN (s // 50) * 50 + 10 + 1 AND (s // 50) * 50 + 40")
def callable_point(spark: SparkSession, d: str) -> DataFrame:
    v = variants(spark, d)
    base = fi.truncated_div("start", 50) * 50
    inside = fi.closed(base + 10, base + 40)
    return v.where(fi.callable_point(F.col("start") + 1, inside["start"], inside["end"])).select("contigName", (F.col("start") + 1).alias("pos"), "key")


@query(f"""WITH {READS}, n AS (SELECT referenceName, max(e) - 5000 AS length FROM reads GROUP BY 1),
b AS (SELECT referenceName, unnest(range((s - 400) // 5000, (e + 400 - 1) // 5000 + 1)) AS bin_id, readName, mappingQuality FROM reads)
SELECT b.referenceName, b.bin_id, b.bin_id * 5000 AS bin_start, least((b.bin_id + 1) * 5000, n.length) AS bin_end, count(*) AS reads, CAST(sum(mappingQuality) AS BIGINT) AS mapping_quality FROM b JOIN n USING (referenceName) WHERE bin_id * 5000 < length GROUP BY ALL""")
def assembly_shards(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    lengths = r.groupBy(F.col("referenceName").alias("contigName")).agg((F.max("end") - 5000).alias("length"))
    s = assembly.shards(r, lengths, size=5000, padding=400)
    return s.groupBy("referenceName", F.col("binId").alias("bin_id"), F.col("binStart").alias("bin_start"), F.col("binEnd").alias("bin_end")).agg(F.count("*").alias("reads"), F.sum("mappingQuality").alias("mapping_quality"))


@query(f"""WITH {VARIANTS}, v AS (SELECT contigName, sampleId, s, max(e) AS e, max(CASE WHEN polymorphic THEN e ELSE -1 END) AS pe FROM variants GROUP BY 1, 2, 3), l AS (SELECT DISTINCT contigName, s FROM v),
n AS (SELECT l.contigName, l.s, v.sampleId, max(v.s) AS latest FROM l JOIN v ON v.contigName = l.contigName AND v.s <= l.s GROUP BY ALL),
h AS (SELECT n.contigName, n.s, v.pe FROM n JOIN v ON v.contigName = n.contigName AND v.sampleId = n.sampleId AND v.s = n.latest WHERE v.e > n.s)
SELECT contigName, s AS start_pos, count(*) AS samples FROM h GROUP BY ALL HAVING max(pe) > s""")
def candidate_loci(spark: SparkSession, d: str) -> DataFrame:
    return vo.candidate_loci(variants(spark, d)).withColumnRenamed("start", "start_pos")


@query(f"WITH {READS}, r AS (SELECT DISTINCT referenceName, s, readName, readInFragment FROM reads), n AS (SELECT *, row_number() OVER (PARTITION BY referenceName, s ORDER BY readName, readInFragment) AS rn FROM r) SELECT referenceName, s AS start_pos, readName, readInFragment FROM n WHERE rn <= 2")
def downsample_starts(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d).select("referenceName", "start", "readName", "readInFragment").distinct()
    return ro.downsample(r, 2).withColumnRenamed("start", "start_pos")


@query("""WITH e AS (SELECT concat('s', CAST(o_custkey % 50 AS VARCHAR)) AS sample_id, concat('g', CAST(o_orderkey AS VARCHAR)) AS read_group_id, concat('/data/', CAST(o_orderkey AS VARCHAR), '_1.fq') AS first_file,
  CASE WHEN o_orderkey % 2 = 0 THEN concat('/data/', CAST(o_orderkey AS VARCHAR), '_2.fq') END AS second_file FROM (SELECT o_orderkey, max(o_custkey) AS o_custkey FROM orders GROUP BY 1))
SELECT sample_id, count(*) AS read_groups, count(second_file) AS paired, min(read_group_id) AS first_group, min(first_file) AS first_input FROM e GROUP BY 1""")
def manifest_groups(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy("o_orderkey").agg(F.max("o_custkey").alias("o_custkey"))
    k = F.col("o_orderkey").cast("string")
    one = lambda n: F.struct(F.concat(F.lit("/data/"), k, F.lit(f"_{n}.fq")).alias("file_path"), F.when(F.col("o_orderkey") % 2 == 0, str(n)).otherwise("").alias("paired_end"))
    sheet = o.select(F.concat(F.lit("s"), (F.col("o_custkey") % 50).cast("string")).alias("sample_id"), F.concat(F.lit("g"), k).alias("read_group_id"), F.explode(F.when(F.col("o_orderkey") % 2 == 0, F.array(one(1), one(2))).otherwise(F.array(one(1)))).alias("f")).select("f.*", "sample_id", "read_group_id")
    m = manifest.samples(sheet)
    return m.select("sample_id", F.size("read_groups").cast("long").alias("read_groups"), F.size(F.filter("read_groups", lambda g: g["secondInput"].isNotNull())).cast("long").alias("paired"), F.array_min(F.transform("read_groups", lambda g: g["read_group_id"])).alias("first_group"), F.array_min(F.transform("read_groups", lambda g: g["input"])).alias("first_input"))


@query(f"WITH {READS}, r AS (SELECT DISTINCT referenceName, s, readName, readInFragment FROM reads) SELECT referenceName, s AS start_pos, readName, readInFragment, row_number() OVER (PARTITION BY referenceName ORDER BY s NULLS LAST, readName, readInFragment) AS ordinal FROM r")
def coordinate_sort_rank(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d).select("referenceName", "start", "readName", "readInFragment").distinct()
    order = (F.asc_nulls_last("referenceName"), F.asc_nulls_last("start"), "readName", "readInFragment")
    return ro.with_ordinals(r, order, "referenceName").withColumnRenamed("start", "start_pos")


@query(f"WITH {READS} SELECT referenceName, s AS start_pos, part FROM reads WHERE library = 'O' UNION ALL SELECT referenceName, s, part FROM reads WHERE readNegativeStrand")
def union_reads(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    c = ["referenceName", F.col("start").alias("start_pos"), "part"]
    return r.where("library = 'O'").select(*c).unionByName(r.where("readNegativeStrand").select(*c))


@query(f"""WITH {READS}, a AS (SELECT referenceName, s AS start_pos, mappingQuality FROM reads WHERE library = 'O'), b AS (SELECT referenceName, s AS start_pos, mappingQuality FROM reads WHERE readNegativeStrand)
SELECT *, 'missing' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'extra' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def diff_reads(spark: SparkSession, d: str) -> DataFrame:
    """Both differences from one count: rows of the first side less those of the second, for each row as it is. Rows on both sides
    at once cancel out before anything is held."""
    told = lambda x: F.when(x, 1).otherwise(0)
    sides = (told(F.col("library") == "O") - told(F.col("readNegativeStrand"))).cast("long")
    rows = reads(spark, d).select("referenceName", F.col("start").alias("start_pos"), "mappingQuality", sides.alias("n")).where("n <> 0")
    left = rows.groupBy("referenceName", "start_pos", "mappingQuality").agg(F.sum("n").alias("n")).where("n <> 0")
    copies = F.explode(F.array_repeat(F.when(F.col("n") > 0, "missing").otherwise("extra"), F.abs("n").cast("int")))
    return left.select("referenceName", "start_pos", "mappingQuality", copies.alias("side"))


@query(f"""WITH {VARIANTS}, a AS (SELECT DISTINCT contigName, s FROM variants WHERE sampleId IN ('S0', 'S1')), b AS (SELECT DISTINCT contigName, s FROM variants WHERE sampleId IN ('S1', 'S2'))
SELECT contigName, s AS start_pos, 'false positive' AS kind FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.contigName = a.contigName AND b.s = a.s) UNION ALL
SELECT contigName, s, 'false negative' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.contigName = a.contigName AND b.s = a.s)""")
def diff_variants(spark: SparkSession, d: str) -> DataFrame:
    v = variants(spark, d).select("contigName", F.col("start").alias("start_pos"), "sampleId")
    a, b = (v.where(F.col("sampleId").isin(*s)).drop("sampleId").distinct() for s in (("S0", "S1"), ("S1", "S2")))
    on = ["contigName", "start_pos"]
    return a.join(b, on, "left_anti").withColumn("kind", F.lit("false positive")).unionByName(b.join(a, on, "left_anti").withColumn("kind", F.lit("false negative")))


@query(f"WITH {VARIANTS} SELECT DISTINCT sampleId FROM variants ORDER BY 1")
def distinct_samples(spark: SparkSession, d: str) -> DataFrame:
    return variants(spark, d).select("sampleId").distinct().orderBy("sampleId")


@query(f"WITH {READS} SELECT count(*) AS reads, CAST(sum(e - s) AS BIGINT) AS bases, CAST(sum(length(readName)) AS BIGINT) AS name_chars FROM reads")
def totals(spark: SparkSession, d: str) -> DataFrame:
    return reads(spark, d).agg(F.count("*").alias("reads"), F.sum(F.col("end") - F.col("start")).alias("bases"), F.sum(F.length("readName")).alias("name_chars"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, x = y OR abs(x - y) <= greatest(2.2250738585072014e-308, 1e-3 * greatest(abs(x), abs(y))) AS eq,
  NOT (x = y) AND x - y < -greatest(2.2250738585072014e-308, 1e-3 * greatest(abs(x), abs(y))) AS lt FROM (SELECT *, l_extendedprice AS x, round(l_extendedprice, -1) AS y FROM lineitem)""")
def fuzzy_eq(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").withColumn("y", F.round("l_extendedprice", -1))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", genotypes.nearly_equal("l_extendedprice", "y", 1e-3).alias("eq"), genotypes.nearly_less("l_extendedprice", "y", 1e-3).alias("lt"))


@query("SELECT event_id, concat(CAST(event_id * 37 // 3600 AS VARCHAR), 'h', CAST(event_id * 37 % 3600 // 60 AS VARCHAR), 'm', CAST(event_id * 37 % 60 AS VARCHAR), 's') AS took FROM events")
def duration_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", genotypes.duration(F.col("event_id") * 37).alias("took"))


@query("SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_id, event_type AS step FROM events")
def provenance_chain(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, d, "events").select("user_id", "event_id", F.lag("event_id").over(w).alias("previous_id"), F.col("event_type").alias("step"))


@query("""WITH r AS (SELECT DISTINCT l_orderkey AS name, l_partkey * 1000 + l_suppkey * 10 + l_linenumber AS s, l_partkey % 2 AS num, l_partkey % 3 <> 0 AS proper, (l_suppkey % 997) * 500 AS mate FROM lineitem),
f AS (SELECT name, arg_min(s + 50 - mate, struct_pack(a := num, b := s)) AS size FROM r WHERE proper AND s > mate GROUP BY 1)
SELECT r.name, r.s AS start_pos, CASE WHEN proper THEN CASE WHEN s > mate THEN -size ELSE size END END AS insert_size FROM r LEFT JOIN f USING (name)""")
def insert_size(spark: SparkSession, d: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), (p * 1000 + s * 10 + F.col("l_linenumber")).alias("start"), (p % 2).alias("readInFragment"), (p % 3 != 0).alias("properPair"), (s % 997 * 500).alias("mateAlignmentStart"), F.lit(True).alias("primaryAlignment")).distinct().withColumn("end", F.col("start") + 50)
    return ro.infer_insert_size(r, "name").select("name", F.col("start").alias("start_pos"), F.col("insertSize").alias("insert_size"))


@query(f"WITH {READS} SELECT readName AS name, library AS read_group, count(*) AS alignments, min(s) AS first_start, max(s) AS last_start FROM reads GROUP BY 1, 2")
def fragments(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d).withColumn("readGroupId", F.col("library")).withColumn("insertSize", F.lit(None).cast("long"))
    f = ro.to_fragments(r)
    return f.select("name", F.col("readGroupId").alias("read_group"), F.explode("alignments").alias("a")).select("name", "read_group", "a.start").groupBy("name", "read_group").agg(F.count("*").alias("alignments"), F.min("start").alias("first_start"), F.max("start").alias("last_start"))


@query(f"""WITH {VARIANTS}, b AS (SELECT contigName, sampleId, s, unnest(range(s // 100, (e - 1) // 100 + 1)) AS bin_id FROM variants)
SELECT contigName, CAST(bin_id AS BIGINT) AS bin_id, bin_id * 100 AS bin_start, s < bin_id * 100 AS is_duplicate, count(*) AS n, count(DISTINCT sampleId) AS samples FROM b GROUP BY ALL""")
def bin_variants(spark: SparkSession, d: str) -> DataFrame:
    v = variants(spark, d).select("contigName", "start", "end", F.array(F.struct("sampleId")).alias("genotypes"), F.array(F.lit("A")).alias("alternateAlleles"))
    return vo.bin_variants(v, 100).groupBy("contigName", F.col("binId").alias("bin_id"), F.col("binStart").alias("bin_start"), F.col("isDuplicate").alias("is_duplicate")).agg(F.count("*").alias("n"), F.countDistinct("sampleId").alias("samples"))


@query("""WITH m AS (SELECT l_returnflag AS g, CAST(l_quantity AS INTEGER) AS q, l_partkey % 10 = 0 AS wrong FROM lineitem WHERE CAST(l_quantity AS INTEGER) >= 6)
SELECT g AS read_group, q AS quality, count(*) AS bases, CAST(sum(CASE WHEN wrong THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM m GROUP BY 1, 2""")
def covariates(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    t = table(spark, d, "lineitem").where(q >= 6).select(F.col("l_returnflag").alias("read_group"), q.alias("quality"), (F.col("l_partkey") % 10 == 0).cast("long").alias("wrong"))
    return t.groupBy("read_group", "quality").agg(F.count("*").alias("bases"), F.sum("wrong").alias("errors"))


from helixframe.plans import roundtrips  # noqa: E402, F401  registers its queries here
