"""Queries of sources, sinks and stages: rows of the driver's tables are written in a format to the shared folder, read back by
the format's reader, and compared with the SQL over the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.model import READ
from helixframe.operators import expression, genotyping, reads as ro, recalibration
from helixframe.plans import stages
from helixframe.plans.catalogue import query
from helixframe.plans.inputs import FEATURES, READS, VARIANTS, features, reads, table, variants
from helixframe.plans.params import Param
from helixframe.plans.pipeline import Pipeline, Stage, extend, load_chain, save_chain
from helixframe.session import scratch_path
from helixframe.sources import alignments, features as sf, manifest, tables, vcf, vcf_source

SAMPLES = ["S0", "S1", "S2", "S3"]


# ---- VCF


def called(spark: SparkSession, d: str) -> DataFrame:
    """VCF rows of one sample each; longer ones end where INFO/END says."""
    v = variants(spark, d).groupBy("contigName", "start", "end", "sampleId").agg(F.max("gq").alias("gq"), F.max("depth").alias("depth"), F.max("pl2").alias("pl2"), F.max("key").alias("key"))
    g = F.struct("sampleId", F.lit(False).alias("phased"), F.array(F.lit(0), F.lit(1)).alias("calls"), "depth", F.col("gq").alias("conditionalQuality"), F.array(F.lit(0), F.col("pl2"), F.lit(999)).alias("phredLikelihoods"))
    return v.select("contigName", "start", "end", F.array(F.concat(F.lit("id"), F.col("key").cast("string"))).alias("names"), F.lit("A").alias("referenceAllele"), F.array(F.lit("T")).alias("alternateAlleles"), F.col("gq").cast("double").alias("qual"), F.array(F.lit("PASS")).alias("filters"), F.col("key").cast("int").alias("INFO_KEY"), F.array(g).alias("genotypes"))


def told(rows: DataFrame) -> DataFrame:
    """VCF rows as the SQL has them; samples without a call are left out."""
    g = rows.select("*", F.explode(F.filter("genotypes", lambda x: x["calls"][0] >= 0)).alias("g"))
    return g.select("contigName", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("names")[0].alias("name"), "qual", F.col("filters")[0].alias("filter"), F.col("INFO_KEY").cast("long").alias("info_key"), F.col("g.sampleId").alias("sampleId"), F.col("g.depth").alias("depth"), F.col("g.conditionalQuality").alias("gq"), F.col("g.phredLikelihoods")[1].alias("pl2"))


VCF_SQL = f"""WITH {VARIANTS} SELECT contigName, s AS start_pos, e AS end_pos, concat('id', CAST(max(key) AS VARCHAR)) AS name, CAST(max(gq) AS DOUBLE) AS qual, 'PASS' AS filter,
  max(key) AS info_key, sampleId, max(depth) AS depth, max(gq) AS gq, max(pl2) AS pl2 FROM variants GROUP BY contigName, s, e, sampleId"""


@query(VCF_SQL)
def vcf_sharded(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "vcf")
    vcf.write_sharded(called(spark, d), path, SAMPLES, codec="gzip")
    return told(vcf.read_vcf(spark, path))


@query(VCF_SQL)
def vcf_single(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "one") + ".vcf"
    vcf.write_single(called(spark, d), path, SAMPLES)
    return told(vcf.read_vcf(spark, path))


@query(VCF_SQL)
def vcf_bgzf_sharded(spark: SparkSession, d: str) -> DataFrame:
    """Blocked gzip, a file a partition, read in parts."""
    path = scratch_path(spark, "vcf")
    vcf.write_sharded(called(spark, d), path, SAMPLES, codec="bgzf")
    return told(vcf.read_vcf(spark, path))


@query(VCF_SQL)
def vcf_bgzf_single(spark: SparkSession, d: str) -> DataFrame:
    """One blocked file, read through the loader of tables and VCF."""
    path = scratch_path(spark, "one") + ".vcf.bgz"
    vcf.write_single(called(spark, d), path, SAMPLES, codec="bgzf")
    return told(tables.load_variants(spark, path))


@query(VCF_SQL + " HAVING contigName = 'chr1' AND s >= 700")
def vcf_source_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Written and read as a data source; tests of contig and start are pushed down to it."""
    path = scratch_path(spark, "source")
    vcf_source.register(spark)
    called(spark, d).write.format("vcf").option("samples", ",".join(SAMPLES)).option("compression", "bgzf").mode("append").save(path)
    return told(spark.read.format("vcf").load(path).where("contigName = 'chr1' and start >= 700"))


@query(f"WITH {VARIANTS} SELECT contigName, s AS start_pos, count(*) AS n FROM (SELECT DISTINCT contigName, s, e, sampleId FROM variants) GROUP BY 1, 2")
def vcf_sites(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "sites")
    vcf.write_sharded(called(spark, d), path, SAMPLES)
    return vcf.read_sites(spark, path).groupBy("contigName", F.col("start").alias("start_pos")).agg(F.count("*").alias("n"))


@query(f"WITH {VARIANTS} SELECT DISTINCT sampleId, 'FORMAT' AS kind, unnest(['DP', 'GQ', 'PL']) AS id FROM variants")
def vcf_header(spark: SparkSession, d: str) -> DataFrame:
    path, rows = scratch_path(spark, "header"), called(spark, d)
    vcf.write_sharded(rows, path, [r.s for r in rows.select(F.explode("genotypes.sampleId").alias("s")).distinct().collect()])  # a row a sample
    head = vcf.header_of(spark, path)
    found = [(s, "FORMAT", f.id) for s in head.samples for f in head.fields("FORMAT").values() if f.id != "GT"]
    return spark.createDataFrame(found, "sampleId string, kind string, id string")


@query(VCF_SQL + " HAVING sampleId IN ('S1', 'S2')")
def partition_export(spark: SparkSession, d: str) -> DataFrame:
    """Calls of two samples replace their partitions of a table that holds others, and are exported from it."""
    path, rows = scratch_path(spark, "calls"), called(spark, d).withColumn("sampleId", F.col("genotypes")[0]["sampleId"])
    tables.save_and_export(rows.withColumn("qual", F.lit(0.0)), path, "sampleId", SAMPLES, SAMPLES)
    mine = rows.where(F.col("sampleId").isin("S1", "S2"))
    tables.save_and_export(mine, path, "sampleId", ["S1", "S2"], ["S1", "S2"], f"{path}.vcf", single=True)
    return told(vcf.read_vcf(spark, f"{path}.vcf"))


# ---- reads


def placed(spark: SparkSession, d: str) -> DataFrame:
    """lineitem in the read model, names unique but for rows equal in all columns."""
    r, t = reads(spark, d), {f.name: f.dataType for f in READ.fields}
    name = F.concat("readName", F.lit("_"), F.col("readInFragment").cast("string"))
    n = (F.col("end") - F.col("start")).cast("int")
    known = {"referenceName": F.col("referenceName"), "start": F.col("start"), "end": F.col("end"), "mappingQuality": F.col("mappingQuality"), "readName": name, "readMapped": F.lit(True), "readNegativeStrand": F.col("readNegativeStrand"), "duplicateRead": F.col("duplicateRead"), "secondaryAlignment": F.col("secondaryAlignment"), "failedVendorQualityChecks": F.col("failedVendorQualityChecks"), "cigar": F.concat(n.cast("string"), F.lit("M")), "sequence": F.expr("repeat('A', cast(`end` - start as int))"), "qualityScores": F.expr("repeat('I', cast(`end` - start as int))"), "attributes": F.concat(F.lit("RG:Z:"), F.col("library")), "readInFragment": F.lit(0)}
    false = {"readPaired", "properPair", "mateMapped", "mateNegativeStrand", "supplementaryAlignment"}
    return r.select(*((known[c] if c in known else F.lit(False) if c in false else F.lit(None)).cast(k).alias(c) for c, k in t.items()))


READ_SQL = f"""WITH {READS} SELECT concat(readName, '_', CAST(readInFragment AS VARCHAR)) AS name, referenceName, s AS start_pos, e AS end_pos, mappingQuality, readNegativeStrand AS negative, duplicateRead AS duplicate,
  secondaryAlignment AS secondary, failedVendorQualityChecks AS failed, library AS read_group, length(repeat('A', CAST(e - s AS INTEGER))) AS bases, count(*) AS n FROM reads GROUP BY ALL"""


def shown(rows: DataFrame) -> DataFrame:
    columns = [F.col("readName").alias("name"), "referenceName", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "mappingQuality", F.col("readNegativeStrand").alias("negative"), F.col("duplicateRead").alias("duplicate"), F.col("secondaryAlignment").alias("secondary"), F.col("failedVendorQualityChecks").alias("failed"), F.col("readGroupId").alias("read_group"), F.length("sequence").cast("long").alias("bases")]
    some = rows.select(*columns)
    return some.groupBy(*some.columns).agg(F.count("*").alias("n"))


CONTIGS = [(f"chr{k}", 1 << 28) for k in range(5)]


@query(READ_SQL)
def sam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "reads")
    alignments.write_sam(placed(spark, d), path, alignments.sam_header(CONTIGS))
    return shown(alignments.read_sam(spark, path))


@query(READ_SQL)
def bam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Sorted, as one file."""
    path = scratch_path(spark, "reads") + ".bam"
    alignments.write_bam(placed(spark, d), path, alignments.sam_header(CONTIGS, sorted_by="coordinate"), CONTIGS, single=True, sort=True)
    return shown(alignments.load_reads(spark, path))


@query(READ_SQL)
def bam_split(spark: SparkSession, d: str) -> DataFrame:
    """One BAM file, read in parts of 200 KB."""
    path = scratch_path(spark, "reads") + ".bam"
    alignments.write_bam(placed(spark, d), path, alignments.sam_header(CONTIGS), CONTIGS, single=True)
    return shown(alignments.read_bam(spark, path, size=200_000))


@query(READ_SQL)
def parquet_reads(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "reads")
    alignments.save_reads(placed(spark, d).withColumn("readGroupId", F.regexp_extract("attributes", "RG:Z:(.*)", 1)), path)
    return shown(alignments.load_reads(spark, path))


@query("""SELECT concat('q', CAST(l_orderkey AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR)) AS name, CAST(l_linenumber % 2 AS INTEGER) AS number,
  translate(CAST(l_partkey AS VARCHAR), '0123456789', 'ACGTNACGTN') AS bases, translate(CAST(l_partkey AS VARCHAR), '0123456789', '@+I#!5J?@+') AS quality, count(*) AS n FROM lineitem GROUP BY ALL""")
def fastq_reads(spark: SparkSession, d: str) -> DataFrame:
    """First and second reads in a file each, whose quality lines may begin as others do."""
    path, t = scratch_path(spark, "fastq"), table(spark, d, "lineitem")
    part = F.col("l_partkey").cast("string")
    record = F.concat(F.lit("@q"), F.concat_ws("_", *(F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey"))), F.lit(" more\n"), F.translate(part, "0123456789", "ACGTNACGTN"), F.lit("\n+\n"), F.translate(part, "0123456789", "@+I#!5J?@+"))
    for k in (0, 1):
        t.where(F.col("l_linenumber") % 2 == k).select(record.alias("value")).write.text(f"{path}/{k}")
    back = alignments.read_fastq(spark, f"{path}/0", f"{path}/1")
    return back.groupBy(F.col("readName").alias("name"), F.col("readInFragment").alias("number"), F.col("sequence").cast("string").alias("bases"), F.col("qualityScores").alias("quality")).agg(F.count("*").alias("n"))


MODEL_SQL = """WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag AS g, 20 + l_linenumber AS q, translate(lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0'), '0123456789', 'ACGTACGTAC') AS seq,
  translate(lpad(CAST((l_partkey + CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 0 END) % 10000 AS VARCHAR), 4, '0'), '0123456789', 'ACGTACGTAC') AS ref FROM lineitem),
b AS (SELECT *, c, substr(seq, greatest(c, 1), 2) AS context, substr(seq, c + 1, 1) <> substr(ref, c + 1, 1) AS wrong FROM r, (VALUES (0), (1), (2), (3)) v(c)),
k AS (SELECT g, q, c, context, CAST(count(*) FILTER (wrong) AS BIGINT) AS errors, count(*) AS n FROM b GROUP BY ALL),
f AS (SELECT g, q, c, context, round(-10 * log10((sum(errors) OVER (PARTITION BY g, q) + 1) / (sum(n) OVER (PARTITION BY g, q) + 2))) AS a,
  round(-10 * log10((sum(errors) OVER (PARTITION BY g, q, c) + 1) / (sum(n) OVER (PARTITION BY g, q, c) + 2))) AS oc, round(-10 * log10((sum(errors) OVER (PARTITION BY g, q, context) + 1) / (sum(n) OVER (PARTITION BY g, q, context) + 2))) AS ox FROM k),
m AS (SELECT g, q, c, context, CAST(least(greatest(oc + ox - a, 1), 60) AS INTEGER) AS nq FROM f)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, string_agg(chr(33 + nq), '' ORDER BY b.c) AS qualities FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, g, q, c, context FROM b) b JOIN m USING (g, q, c, context) GROUP BY ALL"""


def bases_read(spark: SparkSession, d: str) -> DataFrame:
    """Reads of four bases from lineitem, with the reference's."""
    t = table(spark, d, "lineitem")
    bases = lambda x: F.translate(F.lpad((x % 10000).cast("string"), 4, "0"), "0123456789", "ACGTACGTAC")
    return t.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_returnflag").alias("readGroupId"), F.lit("c").alias("referenceName"), F.col("l_orderkey").alias("start"), bases(F.col("l_partkey")).alias("sequence"), F.repeat(F.char(F.col("l_linenumber") + 53), F.lit(4)).alias("qualityScores"), bases(F.col("l_partkey") + F.when(F.col("l_suppkey") % 10 == 0, 1).otherwise(0)).alias("referenceBases"))


@query(MODEL_SQL)
def recalibrated_qualities(spark: SparkSession, d: str) -> DataFrame:
    rows = bases_read(spark, d)
    out = recalibration.apply_recalibration(rows, recalibration.recalibrate(rows, None))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("qualityScores").alias("qualities")).distinct()


KNOWN_SQL = MODEL_SQL.replace("k AS (SELECT g, q, c, context,", "s AS (SELECT DISTINCT o_orderkey AS site FROM orders WHERE o_custkey % 3 = 0), k AS (SELECT g, q, c, context,").replace("FROM b GROUP BY ALL),", "FROM b WHERE l_orderkey + c NOT IN (SELECT site FROM s) GROUP BY ALL),").replace("chr(33 + nq)", "chr(33 + coalesce(nq, q))").replace(") b JOIN m USING", ") b LEFT JOIN m USING")


@query(KNOWN_SQL)
def recalibrated_outside_known_sites(spark: SparkSession, d: str) -> DataFrame:
    """Every third customer's orders are known sites, at which bases do not count."""
    rows = bases_read(spark, d)
    sites = table(spark, d, "orders").where("o_custkey % 3 = 0").select(F.lit("c").alias("contigName"), F.col("o_orderkey").alias("start"))
    out = recalibration.apply_recalibration(rows, recalibration.recalibrate(rows, sites))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("qualityScores").alias("qualities")).distinct()


# ---- features, dictionaries, manifests


@query("""WITH o AS (SELECT DISTINCT o_orderkey AS k, concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS contig FROM orders)
SELECT f AS format, contig, k * 10 AS start_pos, k * 10 + 27 AS end_pos, CASE WHEN f IN ('gtf', 'gff3') THEN concat('t', CAST(k AS VARCHAR)) END AS transcript, CASE WHEN f IN ('gtf', 'gff3') THEN 'transcript' WHEN f = 'narrowPeak' THEN 'peak' END AS kind
FROM o, (VALUES ('bed'), ('narrowPeak'), ('gtf'), ('gff3'), ('interval_list')) v(f)""")
def feature_files(spark: SparkSession, d: str) -> DataFrame:
    """Every order in each interval format; formats count from 0 or 1, closed or half-open."""
    f = features(spark, d).where("featureType = 'transcript'")
    zero, one, end = F.col("start").cast("string"), (F.col("start") + 1).cast("string"), F.col("end").cast("string")
    c, t, dot = F.col("referenceName"), F.col("transcriptId"), F.lit(".")
    lines = {
        "bed": (c, zero, end, t, F.lit("0"), F.lit("+")), "narrowPeak": (c, zero, end, t, F.lit("0"), dot, F.lit("1"), F.lit("1"), F.lit("1"), F.lit("5")),
        "gtf": (c, F.lit("src"), F.lit("transcript"), one, end, dot, F.lit("+"), dot, F.concat(F.lit('gene_id "g"; transcript_id "'), t, F.lit('";'))),
        "gff3": (c, F.lit("src"), F.lit("transcript"), one, end, dot, F.lit("+"), dot, F.concat(F.lit("ID=x;transcript_id="), t)), "interval_list": (c, one, end, F.lit("+"), t),
    }
    out = None
    for name, fields in lines.items():
        path = f"{scratch_path(spark, 'features')}.{name}"
        f.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
        got = sf.read_features(spark, path).select(F.lit(name).alias("format"), F.col("referenceName").alias("contig"), F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("transcriptId").alias("transcript"), F.col("featureType").alias("kind"))
        out = got if out is None else out.unionByName(got)
    return out


@query("SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS contig, concat('t', CAST(o_orderkey AS VARCHAR)) AS transcript, o_orderkey * 10 + 15 * k AS start_pos, o_orderkey * 10 + 15 * k + 12 AS end_pos FROM orders, (VALUES (0), (1)) v(k)")
def saved_features(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "features")
    sf.save_features(features(spark, d), path)
    back = tables.load(spark, path).where("featureType = 'exon'")
    return back.select(F.col("referenceName").alias("contig"), F.col("transcriptId").alias("transcript"), F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


@query("SELECT concat('chr', CAST(n_nationkey AS VARCHAR)) AS contig, CAST(1000 + n_nationkey * 7 AS BIGINT) AS length FROM nation")
def dictionary(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "dictionary") + ".dict"
    k = F.col("n_nationkey")
    table(spark, d, "nation").select(F.concat(F.lit("@SQ\tSN:chr"), k.cast("string"), F.lit("\tLN:"), (k * 7 + 1000).cast("string"), F.lit("\tM5:x")).alias("value")).write.text(path)
    return sf.read_dictionary(spark, path).select(F.col("contigName").alias("contig"), "length")


def sheet(spark: SparkSession, d: str) -> DataFrame:
    """Read groups of customers: two ends in a file each, or one unpaired."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    file = lambda n: F.struct(F.concat(F.lit("fq/"), F.col("k").cast("string"), F.lit(f"_{n}.fq")).alias("file_path"), F.lit(str(n)).alias("paired_end"))
    alone = F.struct(F.concat(F.lit("/abs/"), F.col("k").cast("string"), F.lit(".bam")).alias("file_path"), F.lit("").alias("paired_end"))
    return c.select("k", F.explode(F.when(F.col("k") % 2 == 0, F.array(file(1), file(2))).otherwise(F.array(alone))).alias("f")).select("k", "f.*", F.concat(F.lit("g"), F.col("k").cast("string")).alias("read_group_id"))


@query("""WITH c AS (SELECT c_custkey AS k FROM customer) SELECT concat('s', CAST(k % 20 AS VARCHAR)) AS sample_id, concat('g', CAST(k AS VARCHAR)) AS read_group_id,
  CASE WHEN k % 2 = 0 THEN concat('fq/', CAST(k AS VARCHAR), '_1.fq') ELSE concat('/abs/', CAST(k AS VARCHAR), '.bam') END AS first_file, CASE WHEN k % 2 = 0 THEN concat('fq/', CAST(k AS VARCHAR), '_2.fq') END AS second_file FROM c""")
def manifest_file(spark: SparkSession, d: str) -> DataFrame:
    """Sheets written as CSV; relative entries lie in the sheet's folder."""
    folder = scratch_path(spark, "manifest")
    rows = sheet(spark, d).select("file_path", F.concat(F.lit("s"), (F.col("k") % 20).cast("string")).alias("sample_id"), "paired_end", "read_group_id")
    rows.write.option("header", True).option("emptyValue", "").csv(f"{folder}/sheet.csv")
    got = manifest.load_samples(spark, f"{folder}/sheet.csv").select("sample_id", F.explode("read_groups").alias("g")).select("sample_id", "g.*")
    near = lambda c: F.when(F.startswith(c, F.lit(f"{folder}/")), F.substring(c, len(folder) + 2, 1 << 30)).otherwise(c)
    return got.select("sample_id", "read_group_id", near(F.col("input")).alias("first_file"), near(F.col("secondInput")).alias("second_file"))


@query("""SELECT concat('p', CAST(c_custkey % 30 AS VARCHAR)) AS pair_id, CASE WHEN c_custkey // 30 % 2 = 0 THEN 'tumor' ELSE 'normal' END AS label, concat('s', CAST(c_custkey % 30 AS VARCHAR), '_', CAST(c_custkey // 30 % 2 AS VARCHAR)) AS sample_id, count(*) AS read_groups FROM customer GROUP BY ALL""")
def manifest_pairs(spark: SparkSession, d: str) -> DataFrame:
    side, pair = F.call_function("div", F.col("k"), F.lit(30).cast("long")) % 2, (F.col("k") % 30).cast("string")
    rows = sheet(spark, d).select(F.concat(F.lit("p"), pair).alias("pair_id"), "file_path", F.concat(F.lit("s"), pair, F.lit("_"), side.cast("string")).alias("sample_id"), F.when(side == 0, "tumor").otherwise("normal").alias("label"), "paired_end", "read_group_id")
    got = manifest.pairs(rows).select("pair_id", F.explode("samples").alias("s"))
    return got.select("pair_id", "s.label", "s.sample_id", F.size("s.read_groups").cast("long").alias("read_groups"))


# ---- tables


@query("""SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL
UNION ALL SELECT 'R', l_linestatus, count(*), CAST(sum(l_partkey + 1) AS BIGINT) FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber < 3 GROUP BY ALL""")
def replaced_partitions(spark: SparkSession, d: str) -> DataFrame:
    """One of three partitions is replaced by other rows, one that gets none is emptied, the others stay."""
    path, t = scratch_path(spark, "table"), table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_partkey").alias("part"), "l_linenumber")
    tables.replace_partitions(t.unionByName(t.limit(1).withColumn("flag", F.lit("X"))), path, "flag", ["A", "N", "R", "X"])
    tables.replace_partitions(t.where("flag = 'R' and l_linenumber < 3").withColumn("part", F.col("part") + 1), path, "flag", ["R", "X"])
    return tables.load(spark, path).groupBy("flag", "status").agg(F.count("*").alias("n"), F.sum("part").alias("parts"))


@query("SELECT o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def partition_in_path(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "table")
    table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).write.partitionBy("status").parquet(path)
    return tables.load(spark, f"{path}/status=F").groupBy("priority").agg(F.count("*").alias("n"))


@query("""SELECT mode, CAST(count(*) * copies AS BIGINT) AS n FROM nation, (VALUES ('append', 2), ('overwrite', 1), ('ignore', 1), ('errorifexists', 1)) v(mode, copies) GROUP BY mode, copies""")
def save_modes(spark: SparkSession, d: str) -> DataFrame:
    """Each mode onto a table that is there."""
    t, out = table(spark, d, "nation"), []
    for mode in ("append", "overwrite", "ignore", "errorifexists"):
        path = scratch_path(spark, mode)
        tables.save(t, path)
        try:
            tables.save(t, path, mode)
        except Exception:  # noqa: BLE001  what errorifexists is for
            if mode != "errorifexists":
                raise
        out.append(spark.read.parquet(path).agg(F.lit(mode).alias("mode"), F.count("*").alias("n")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("SELECT r_regionkey AS region, r_regionkey <> 0 AS there, r_regionkey > 1 AS complete, CAST(CASE WHEN r_regionkey > 0 THEN (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) ELSE 0 END AS BIGINT) AS nations FROM region")
def commit_markers(spark: SparkSession, d: str) -> DataFrame:
    """The nations of each region are a table: one is never written, one loses its marker, the others are finished."""
    path, seen = scratch_path(spark, "markers"), []
    for r in table(spark, d, "region").collect():  # five regions
        k, one = r.r_regionkey, f"{path}/{r.r_regionkey}"
        if k:
            tables.save(table(spark, d, "nation").where(F.col("n_regionkey") == k), one)
        if k == 1:
            tables.delete(spark, f"{one}/_SUCCESS")
        seen.append((k, tables.exists(spark, one), tables.complete(spark, one)))
    counts = tables.load(spark, f"{path}/*").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("nations"))
    told = spark.createDataFrame(seen, "region int, there boolean, complete boolean")
    return told.join(counts, "region", "left").withColumn("nations", F.coalesce("nations", F.lit(0).cast("long")))


# ---- stages and pipelines


@query(VCF_SQL)
def ingest_stage(spark: SparkSession, d: str) -> DataFrame:
    """gVCFs of a list to a table of single-sample rows; likelihoods are checked."""
    path = scratch_path(spark, "ingest")
    for s in SAMPLES:
        vcf.write_single(called(spark, d).where(F.col("genotypes")[0]["sampleId"] == s), f"{path}/{s}.vcf", [s])
    Pipeline("ingest", [stages.IngestVariants()]).init({"manifest": "\n".join(f"{path}/{s}.vcf" for s in SAMPLES), "gvcfDeltaOutput": f"{path}/table", "performValidation": True}).execute(spark)
    return told(tables.load(spark, f"{path}/table"))


@query(VCF_SQL + " HAVING (contigName = 'chr0' AND s < 700 AND e > 35) OR (contigName = 'chr2' AND s < 7000 AND e > 5600)")
def ingest_regions(spark: SparkSession, d: str) -> DataFrame:
    """As ingest_stage, within regions of a BED file, few enough to be pushed down."""
    path = scratch_path(spark, "ingest")
    vcf.write_sharded(called(spark, d), f"{path}/rows", SAMPLES)
    spark.createDataFrame([("chr0\t35\t700",), ("chr2\t5600\t7000",)], "value string").coalesce(1).write.text(f"{path}/regions.bed")
    return told(stages.ingest(spark, [f"{path}/rows"], f"{path}/regions.bed", False, "STRICT"))


@query(f"""WITH {READS}, tx AS (SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS contig, concat('t', CAST(o_orderkey AS VARCHAR)) AS transcript, o_orderkey * 10 AS ts FROM orders),
x AS (SELECT contig, transcript, ts + 15 * k AS fs, ts + 15 * k + 12 AS fe FROM tx, (VALUES (0), (1)) v(k)), c AS (SELECT transcript, count(*) AS n FROM x JOIN reads ON contig = referenceName AND s < fe AND e > fs GROUP BY 1)
SELECT transcript, contig, coalesce(CAST(n AS DOUBLE), 0.0) AS score, 'sam1' AS source FROM tx LEFT JOIN c USING (transcript)""")
def quantify_stage(spark: SparkSession, d: str) -> DataFrame:
    """Reads per transcript of a stored sample, with gene models from a GTF, by the stage."""
    path = scratch_path(spark, "quantify")
    alignments.save_reads(placed(spark, d).withColumn("readGroupSampleId", F.lit("sam1")), f"{path}/reads/sampleId=sam1")
    f = features(spark, d)
    line = F.concat_ws("\t", "referenceName", F.lit("src"), "featureType", (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('transcript_id "'), F.col("transcriptId"), F.lit('";')))
    f.select(line.alias("value")).write.text(f"{path}/models.gtf")
    Pipeline("count", [stages.Count("sam1")]).init({"alignmentOutput": f"{path}/reads", "quantificationOutput": f"{path}/out", "gtfPath": f"{path}/models.gtf"}).execute(spark)
    return tables.load(spark, f"{path}/out/sampleId=sam1").select(F.col("transcriptId").alias("transcript"), F.col("referenceName").alias("contig"), "score", "source")


GENOME = "ACGTTGCAATC"
JOINT_SQL = f"""WITH {VARIANTS}, o AS (SELECT contigName, s, sampleId, max(key) AS key FROM variants GROUP BY ALL),
g AS (SELECT v.contigName, v.s, v.e, v.sampleId, v.polymorphic AS poly, v.e - v.s > 1 AS del, substr(repeat('{GENOME}', 8), CAST(v.s % 11 + 1 AS BIGINT), CASE WHEN v.polymorphic THEN v.e - v.s ELSE 1 END) AS ref, v.cust FROM variants v JOIN o ON v.contigName = o.contigName AND v.s = o.s AND v.sampleId = o.sampleId AND v.key = o.key),
a AS (SELECT *, CASE WHEN del THEN left(ref, 1) WHEN cust % 2 = 0 THEN translate(ref, 'ACGT', 'CGTA') ELSE translate(ref, 'ACGT', 'GTAC') END AS alt FROM g),
l AS (SELECT contigName, s, max(ref) FILTER (length(ref) = longest) AS reference FROM (SELECT *, max(length(ref)) OVER (PARTITION BY contigName, s) AS longest FROM a) GROUP BY contigName, s HAVING bool_or(poly)),
n AS (SELECT l.contigName, l.s, a.sampleId, max(a.s) AS latest FROM l JOIN a ON a.contigName = l.contigName AND a.s <= l.s GROUP BY ALL),
h AS (SELECT n.contigName, n.s, n.sampleId, a.s AS at, a.e, a.poly, a.del, a.ref, a.alt FROM n JOIN a ON a.contigName = n.contigName AND a.sampleId = n.sampleId AND a.s = n.latest WHERE a.e > n.s),
x AS (SELECT h.contigName, h.s, CASE WHEN h.at = h.s THEN concat(h.alt, substr(l.reference, length(h.ref) + 1)) ELSE '*' END AS alt FROM h JOIN l ON h.contigName = l.contigName AND h.s = l.s WHERE h.poly AND (h.at = h.s OR h.del)),
m AS (SELECT contigName, s, string_agg(DISTINCT alt, ',' ORDER BY alt) AS alternates FROM x GROUP BY ALL)
SELECT l.contigName, l.s AS start_pos, l.s + length(l.reference) AS end_pos, l.reference, m.alternates, k.sampleId, h.sampleId IS NOT NULL AS called
FROM l JOIN m ON l.contigName = m.contigName AND l.s = m.s CROSS JOIN (SELECT unnest(['S0', 'S1', 'S2', 'S3']) AS sampleId) k LEFT JOIN h ON h.contigName = l.contigName AND h.s = l.s AND h.sampleId = k.sampleId"""


@query(JOINT_SQL)
def joint_sites(spark: SparkSession, d: str) -> DataFrame:
    """Joint genotyping of four samples' gVCF rows: alleles of each site against its longest reference, spanning deletions, and
    which samples have no call. Likelihoods leave no doubt, so all alleles stay."""
    v = variants(spark, d)
    v = v.join(v.groupBy("contigName", "start", "sampleId").agg(F.max("key").alias("key")), ["contigName", "start", "sampleId", "key"])
    poly, deletion = F.col("polymorphic"), F.col("end") - F.col("start") > 1
    ref = F.substr(F.repeat(F.lit(GENOME), F.lit(8)), (F.col("start") % 11 + 1).cast("int"), F.when(poly, F.col("end") - F.col("start")).otherwise(1).cast("int"))
    rows = v.withColumn("referenceAllele", ref)
    alt = F.when(deletion, F.left("referenceAllele", F.lit(1))).when(F.col("cust") % 2 == 0, F.translate("referenceAllele", "ACGT", "CGTA")).otherwise(F.translate("referenceAllele", "ACGT", "GTAC"))
    pls = F.when(poly, F.array(*map(F.lit, (300, 0, 300, 300, 300, 300)))).otherwise(F.array(*map(F.lit, (0, 300, 300))))
    g = F.struct("sampleId", F.array(F.lit(0), F.when(poly, 1).otherwise(0)).alias("calls"), pls.alias("phredLikelihoods"))
    rows = rows.select("contigName", "start", "end", "referenceAllele", F.when(poly, F.array(alt, F.lit("<NON_REF>"))).otherwise(F.array(F.lit("<NON_REF>"))).alias("alternateAlleles"), F.array(g).alias("genotypes"))
    out = genotyping.genotype(rows, SAMPLES, size=1_000_000)
    return out.select("contigName", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("referenceAllele").alias("reference"), F.array_join(F.array_sort("alternateAlleles"), ",").alias("alternates"), F.explode("genotypes").alias("g")).select("contigName", "start_pos", "end_pos", "reference", "alternates", F.col("g.sampleId").alias("sampleId"), (F.col("g.calls")[0] >= 0).alias("called"))


class Filtered(Stage):
    """Rows of orders of one status."""

    name = "filtered"
    params = (Param("tables", "folder of the tables"), Param("status", "order status", str, "F"), Param("filteredOutput", "where"))
    outputs = ("filteredOutput",)

    def output_exists(self, spark: SparkSession) -> bool:
        return tables.complete(spark, self.get("filteredOutput"))

    def execute(self, spark: SparkSession) -> None:
        tables.save(table(spark, self.get("tables"), "orders").where(F.col("o_orderstatus") == self.get("status")), self.get("filteredOutput"))


class Counted(Stage):
    """Rows a customer of what an earlier stage left."""

    name = "counted"
    params = (Param("filteredOutput", "rows"), Param("countedOutput", "where"))
    outputs = ("countedOutput",)

    def execute(self, spark: SparkSession) -> None:
        rows = tables.load(spark, self.get("filteredOutput"))
        tables.save(rows.groupBy("o_custkey").agg(F.count("*").alias("n")), self.get("countedOutput"), "overwrite")


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def pipeline_run(spark: SparkSession, d: str) -> DataFrame:
    """Two chained stages; run again, the first is skipped as its output is there."""
    path = scratch_path(spark, "pipeline")
    for _ in range(2):
        Pipeline("count", [Filtered(), Counted()]).init({"tables": d, "status": "O", "filteredOutput": f"{path}/rows", "countedOutput": f"{path}/counts"}).execute(spark)
    return tables.load(spark, f"{path}/counts")


@query("WITH n AS (SELECT r_regionkey AS k FROM region) SELECT CAST(k AS INTEGER) AS ordinal, concat('p', CAST(k % 2 AS VARCHAR), '-', CAST(k AS VARCHAR)) AS id, CASE WHEN k > 0 THEN concat('p', CAST((k - 1) % 2 AS VARCHAR), '-', CAST(k - 1 AS VARCHAR)) END AS previous_id, concat('v', CAST(k AS VARCHAR)) AS version FROM n")
def stored_provenance(spark: SparkSession, d: str) -> DataFrame:
    path, chain = scratch_path(spark, "chain"), []
    for r in table(spark, d, "region").orderBy("r_regionkey").collect():  # five regions
        chain = extend(chain, f"p{r.r_regionkey % 2}", f"v{r.r_regionkey}", "run")
    save_chain(spark, chain, path)
    return spark.createDataFrame([(k, s.id, s.previous_id, s.version) for k, s in enumerate(load_chain(spark, path))], "ordinal int, id string, previous_id string, version string")


@query("""SELECT lower(replace(n_name, ' ', '_')) AS name, CASE WHEN n_regionkey > 0 THEN CAST(n_nationkey AS VARCHAR) END AS visible_default, n_regionkey = 0 AS required FROM nation WHERE n_regionkey < 4
UNION ALL SELECT 'replayMode', 'skip', false FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'table_' || r_regionkey, NULL, true FROM region""")
def visible_parameters(spark: SparkSession, d: str) -> DataFrame:
    """Parameters of a pipeline whose stages are the regions and whose parameters their nations; those of one region are hidden."""

    def stage(region: int, own: list) -> Stage:
        kinds = [Param(r.n_name.lower().replace(" ", "_"), "a nation", int if region else str, r.n_nationkey if region else None, visible=region < 4) for r in own]
        return type("OfRegion", (Stage,), {"params": (*kinds, Param(f"table_{region}", "output")), "outputs": (f"table_{region}",)})()

    nations = table(spark, d, "nation").orderBy("n_nationkey").collect()  # 25 nations
    regions_ = [r.r_regionkey for r in table(spark, d, "region").collect()]
    found = Pipeline("nations", [stage(k, [r for r in nations if r.n_regionkey == k]) for k in regions_]).visible_params()
    return spark.createDataFrame([(p["name"], p["default"], p["required"]) for p in found], "name string, visible_default string, required boolean")


@query(f"WITH {READS}, r AS (SELECT readName, readInFragment, s, referenceName FROM reads) SELECT referenceName, CAST(s // 1000000 % 8 AS INTEGER) AS part, count(*) AS n FROM r GROUP BY ALL")
def explicit_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Rows dealt to the partition that a column names."""
    r = reads(spark, d).select("referenceName", (F.call_function("div", F.col("start"), F.lit(1_000_000).cast("long")) % 8).cast("int").alias("wanted"))
    dealt = ro.by_partition(r, "wanted", 8).withColumn("part", F.spark_partition_id())
    return dealt.groupBy("referenceName", "part").agg(F.count("*").alias("n"))


@query(f"WITH {READS} SELECT readName AS name, row_number() OVER (PARTITION BY referenceName ORDER BY s, readName, readInFragment, part) AS place, referenceName FROM reads")
def coordinate_order(spark: SparkSession, d: str) -> DataFrame:
    """Places in global coordinate order, from ranges sorted in parallel."""
    r = reads(spark, d).select("referenceName", "start", "readName", "readInFragment", "part")
    order = (F.asc_nulls_last("referenceName"), F.asc_nulls_last("start"), "readName", "readInFragment", "part")
    return ro.with_ordinals(r, order, "referenceName", "place").select(F.col("readName").alias("name"), "place", "referenceName")


@query(f"""WITH {READS}, {FEATURES}, c AS (SELECT transcriptId, count(*) AS n FROM exons JOIN reads ON contig = referenceName AND s < fe AND e > fs GROUP BY 1)
SELECT transcriptId AS transcript, CAST(n AS DOUBLE) AS score FROM c ORDER BY n DESC, transcriptId LIMIT 10""")
def first_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report over all transcripts, where the limit is the feature."""
    f = features(spark, d)
    scored = expression.score_transcripts(f, expression.count_reads(f, reads(spark, d)), "s")
    return scored.select(F.col("transcriptId").alias("transcript"), "score").orderBy(F.desc("score"), "transcript").limit(10)
