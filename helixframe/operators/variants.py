"""Operators on variant rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.genotypes import has_valid_pls
from helixframe.functions.intervals import is_duplicate_bin
from helixframe.operators.intervals import running, with_bins

NON_REF = "<NON_REF>"
SPANNING = "*"


def split_samples(variants: DataFrame) -> DataFrame:
    """One row per sample: the genotypes array holds a single genotype."""
    return variants.withColumn("_g", F.explode("genotypes")).withColumn("genotypes", F.array("_g")).drop("_g")


def validate_likelihoods(variants: DataFrame, stringency: str = "STRICT") -> DataFrame:
    """Rows whose first genotype has enough likelihoods. STRICT raises on others, LENIENT and SILENT drop them."""
    fields = variants.schema["genotypes"].dataType.elementType.fieldNames()
    g = F.get("genotypes", F.lit(0))
    size = lambda f: F.coalesce(F.size(g[f]), F.lit(0)) if f in fields else F.lit(0)
    alts = F.coalesce(F.size("alternateAlleles"), F.lit(0))
    ok = F.coalesce(has_valid_pls(alts, size("calls"), size("phredLikelihoods"), size("genotypeLikelihoods")), F.lit(True))
    if stringency.upper() == "STRICT":
        where = F.concat(F.lit("too few genotype likelihoods at "), F.col("contigName"), F.lit(":"), F.col("start").cast("string"))
        return variants.where(F.when(ok, True).otherwise(F.raise_error(where).cast("boolean")))
    if stringency.upper() not in ("LENIENT", "SILENT"):
        raise ValueError(f"unknown stringency {stringency!r}")
    return variants.where(ok)


def bin_variants(variants: DataFrame, size: int, partitions: int | None = None) -> DataFrame:
    """Rows dealt by (contigName, binId) and sorted inside, with binStart and isDuplicate (an earlier bin has the row)."""
    binned = with_bins(variants.withColumn("sampleId", F.get("genotypes", F.lit(0))["sampleId"]), size)
    marked = binned.withColumn("binStart", F.col("binId") * size).withColumn("isDuplicate", is_duplicate_bin("start", "binId", size))
    dealt = marked.repartition(partitions, "contigName", "binId") if partitions else marked.repartition("contigName", "binId")
    return dealt.sortWithinPartitions("contigName", "binId", "start", "sampleId", "alternateAlleles")


def panel_of_normals(variants: DataFrame, panel: DataFrame) -> DataFrame:
    """Variants at sites that the panel lacks; alleles don't matter."""
    return variants.join(panel.select("contigName", "start").distinct(), ["contigName", "start"], "left_anti")


def band_of(quality: Column | str, bounds: list[int]) -> Column:
    """Number of the band a genotype quality falls into; each bound starts a band, 0 the first."""
    q = F.col(quality) if isinstance(quality, str) else quality
    return sum((F.when(q >= b, 1).otherwise(0) for b in sorted(bounds)), F.lit(0))


def islands(sites: DataFrame, bounds: list[int], contig: str = "contigName", start: str = "start", end: str = "end", quality: str = "gq", hom_ref: str = "homRef", sample: tuple[str, ...] = ()) -> DataFrame:
    """Adds `band` and `island`: a new island starts where contig, band or hom-ref-ness changes, at a gap, and at every
    site that is not hom-ref. Sites are ranked in bins of a contig, never a contig as a whole."""
    keys = [contig, *sample]
    banded = sites.withColumn("band", F.when(F.col(hom_ref), band_of(quality, bounds)).otherwise(-1))
    near = running(banded, keys, [start, end], last={"_band": "band", "_end": end})
    new = (F.col("_band") != F.col("band")) | (F.col("_end") != F.col(start)) | ~F.col(hom_ref)
    marked = near.withColumn("_new", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).drop("_band", "_end")
    return running(marked, keys, [start, end], sums={"island": "_new"}).drop("_new")


def gvcf_bands(variants: DataFrame, bounds: list[int]) -> DataFrame:
    """Hom-ref sites of a single-sample gVCF merged into bands; other rows pass. A block takes its first row's alleles,
    the least depth (MIN_DP), the least quality of its sites and the element-wise least likelihoods."""
    g = F.get("genotypes", F.lit(0))
    hom_ref = F.forall(F.coalesce(g["calls"], F.array()), lambda c: c == 0) & (F.size("alternateAlleles") == 1) & (F.element_at("alternateAlleles", 1) == NON_REF)
    flat = variants.select("contigName", "start", "end", "names", "referenceAllele", "alternateAlleles", g.alias("g"), hom_ref.alias("homRef"), g["conditionalQuality"].alias("gq"), g["sampleId"].alias("sampleId"))
    marked = islands(flat, bounds, sample=("sampleId",))
    pls = lambda k: F.min(F.get("g.phredLikelihoods", F.lit(k)))
    out = marked.groupBy("contigName", "sampleId", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("referenceAllele", "start").alias("referenceAllele"),
        F.min_by("alternateAlleles", "start").alias("alternateAlleles"), F.min_by("g", "start").alias("g"), F.first("homRef").alias("homRef"),
        F.min("gq").alias("gq"), F.min("g.depth").alias("minDepth"), F.count("*").alias("sites"), F.array(*map(pls, range(3))).alias("pls"),
    )
    return out.drop("island").withColumn("pls", F.when(F.col("homRef"), F.col("pls")).otherwise(F.col("g.phredLikelihoods")))


def banded(variants: DataFrame, bounds: list[int]) -> DataFrame:
    """As gvcf_bands, with the columns of `variants`: a block's genotype has the least quality, depth and likelihoods of its
    sites, other rows are as they were."""
    g = F.get("genotypes", F.lit(0))
    hom_ref = F.forall(F.coalesce(g["calls"], F.array()), lambda c: c == 0) & (F.size("alternateAlleles") == 1) & (F.element_at("alternateAlleles", 1) == NON_REF)
    flat = variants.select("contigName", "start", "end", F.struct(*variants.columns).alias("row"), hom_ref.alias("homRef"), g["conditionalQuality"].alias("gq"), g["depth"].alias("depth"), g["phredLikelihoods"].alias("pl"), g["sampleId"].alias("sampleId"))
    least = lambda k: F.min(F.get("pl", F.lit(k)))
    out = islands(flat, bounds, sample=("sampleId",)).groupBy("contigName", "sampleId", "island").agg(
        F.min_by("row", "start").alias("row"), F.max("end").alias("end"), F.first("homRef").alias("homRef"), F.min("gq").alias("gq"), F.min("depth").alias("depth"), F.array(*map(least, range(3))).alias("pls")
    )
    one = F.get("row.genotypes", F.lit(0)).withField("conditionalQuality", F.col("gq")).withField("depth", F.col("depth")).withField("phredLikelihoods", F.col("pls"))
    return out.withColumn("row", F.when(F.col("homRef"), F.col("row").withField("end", F.col("end")).withField("genotypes", F.array(one))).otherwise(F.col("row"))).select("row.*")


def snp_index(sites: DataFrame) -> DataFrame:
    """(contigName, first, last): places of each contig's sites in the list sorted by contig and start. Counts per contig
    and a running sum over contigs; sites themselves are never numbered."""
    counts = sites.groupBy("contigName").agg(F.count("*").alias("n"))
    w = Window.orderBy("contigName")  # one row per contig
    upto = F.sum("n").over(w)
    return counts.select("contigName", (upto - F.col("n")).alias("first"), (upto - 1).alias("last"))


def is_polymorphic(alternates: Column | str) -> Column:
    """Whether there is an alternate allele beside <NON_REF> and symbols."""
    a = F.col(alternates) if isinstance(alternates, str) else alternates
    return F.exists(a, lambda x: ~x.startswith("<") & (x != SPANNING) & (x != "."))


def candidate_loci(rows: DataFrame, polymorphic: str = "polymorphic", contig: str = "contigName", start: str = "start", end: str = "end", sample: str = "sampleId") -> DataFrame:
    """Distinct loci (contig, start) where some sample's latest row at or before the locus still reaches it and is
    polymorphic, with the number of samples whose latest row reaches the locus.

    A sample's row counts from its start to its end or the sample's next row, whichever comes first. These spans are swept:
    +1 where one opens, -1 where it closes, in running sums over bins of a contig. Loci meet no samples, so a dense contig
    of many samples costs a few rows for each of theirs."""
    latest = rows.groupBy(F.col(contig).alias("c"), F.col(sample).alias("s"), F.col(start).alias("at")).agg(F.max(end).alias("e"), F.max(F.when(F.col(polymorphic), F.col(end))).alias("pe"))
    upto = F.coalesce(F.lead("at").over(Window.partitionBy("c", "s").orderBy("at")), F.lit((1 << 62)))
    spans = latest.select("c", "at", F.least("e", upto).alias("stop"), F.least("e", "pe", upto).alias("poly_stop"), F.col("pe").isNotNull().alias("poly"))
    here, poly = F.col("stop") > F.col("at"), F.col("poly") & (F.col("poly_stop") > F.col("at"))
    one = lambda at, n, p, locus: F.struct(at.alias("at"), n.cast("long").alias("n"), p.cast("long").alias("p"), F.lit(locus).alias("locus"))
    steps = F.array(one(F.col("at"), F.when(here, 1).otherwise(0), F.when(poly, 1).otherwise(0), 1), one(F.col("stop"), F.when(here, -1).otherwise(0), F.lit(0), 0), one(F.coalesce("poly_stop", "at"), F.lit(0), F.when(poly, -1).otherwise(0), 0))
    events = spans.select("c", F.explode(steps).alias("x")).groupBy("c", F.col("x.at").alias("at")).agg(F.sum("x.n").alias("n"), F.sum("x.p").alias("p"), F.max("x.locus").alias("locus"))
    swept = running(events, ["c"], ["at"], sums={"samples": "n", "polymorphic": "p"})
    return swept.where("locus = 1 and polymorphic > 0").select(F.col("c").alias(contig), F.col("at").alias(start), "samples")
