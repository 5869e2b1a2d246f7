"""The concrete stages and pipelines. Heavy kernels (aligner, region caller, joint genotyper) are functions given to the
stages; what is here is how data reach them and what becomes of their rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.sequence import DEFAULT_QUALITY_BINS, bin_qualities
from helixframe.operators import assembly, callers, expression, genotyping, kernels, recalibration, somatic
from helixframe.operators import intervals as oi
from helixframe.operators import reads as ro
from helixframe.operators import variants as vo
from helixframe.plans.params import Param, Settings
from helixframe.plans.pipeline import MultiSample, Pipeline, Stage, extend, save_chain, stages_of
from helixframe.session import own_session
from helixframe.sources import alignments, fasta, features, manifest, tables, vcf

VERSION = "1"
Aligner = Callable[[DataFrame], DataFrame]
TEXT = dict(optional=True)
MODES = ("append", "overwrite", "errorifexists", "ignore")


class Align(Stage):
    """Raw reads of a sample's read groups to aligned reads: pairing, alignment, duplicates, recalibration, bins, export."""

    name = "Align"
    params = (
        Param("alignmentOutput", "folder of the aligned reads"), Param("pairedEndMode", "keep proper pairs only", bool, True), Param("markDuplicates", "mark duplicates", bool, False),
        Param("binQualityScores", "bin base qualities", bool, False), Param("qualityScoreBinSpec", "bins low,high,base;...", str, DEFAULT_QUALITY_BINS),
        Param("recalibrateBaseQualities", "recalibrate base qualities", bool, False), Param("knownSites", "VCF of sites to leave out of recalibration", str, ""),
        Param("functionalEquivalence", "mark duplicates, recalibrate and bin", bool, False), Param("referenceGenomeFastaPath", "FASTA of a custom reference", str, ""),
        Param("exportBam", "also write SAM or BAM", bool, False), Param("bamOutput", "where", **TEXT), Param("exportBamAsSingleFile", "as one file", bool, False), Param("sortOnSave", "in coordinate order", bool, False),
    )
    outputs = ("alignmentOutput",)

    def __init__(self, sample: str, groups: list[tuple[str, str, str | None]], aligner: Aligner, contigs: list[tuple[str, int]] = (), suffix: str = "", **values: object) -> None:
        if suffix:  # several aligners of one pipeline have outputs of their own names
            self.params = tuple(Param(p.name + suffix, p.doc, p.kind, p.default, p.optional) if p.name == "alignmentOutput" else p for p in self.params)
            self.outputs = (f"alignmentOutput{suffix}",)
        super().__init__(**values)
        self.sample, self.groups, self.aligner, self.contigs = sample, groups, aligner, list(contigs)

    @property
    def path(self) -> str:
        return f"{self.get(self.outputs[0])}/sampleId={self.sample}"

    @property
    def aside(self) -> str:
        return f"{self.get(self.outputs[0])}/_unrecalibrated-{self.sample}"

    def init(self) -> None:
        if (self.get("recalibrateBaseQualities") or self.get("functionalEquivalence")) and self.get("referenceGenomeFastaPath") and not self.get("knownSites"):
            raise ValueError("recalibration with a custom reference genome needs knownSites")

    def output_exists(self, spark: SparkSession) -> bool:
        return tables.complete(spark, self.path)

    def aligned(self, spark: SparkSession) -> DataFrame:
        def one(group: str, first: str, second: str | None) -> DataFrame:
            raw = alignments.load_reads(spark, first, second)
            ordered = ro.pair_reads(raw) if self.get("pairedEndMode") and second else raw
            return self.aligner(ro.for_alignment(ordered, s.alignmentPartitions, s.alignmentMinPartitions)).withColumn("readGroupId", F.lit(group)).withColumn("readGroupSampleId", F.lit(self.sample))

        s = Settings.of(spark)
        reads = reduce(DataFrame.unionByName, (one(*g) for g in self.groups))
        every = self.get("functionalEquivalence")
        if every or self.get("markDuplicates"):
            reads = reads.repartition(s.markDuplicatesPartitions, "readName") if s.markDuplicatesPartitions else reads
            reads = ro.to_reads(ro.mark_duplicates(ro.to_fragments(reads)))
        if every or self.get("recalibrateBaseQualities"):
            # stored first: the model and the new qualities are two passes that must see the same rows
            tables.delete(spark, self.aside)
            ro.with_reference(reads).write.parquet(self.aside)
            reads = spark.read.parquet(self.aside)
            known = vcf.read_spans(spark, self.get("knownSites")) if self.get("knownSites") else None
            told = reads.where("readMapped and coalesce(primaryAlignment, true) and not coalesce(supplementaryAlignment, false) and not coalesce(duplicateRead, false) and not coalesce(failedVendorQualityChecks, false)")
            reads = recalibration.apply_recalibration(reads, recalibration.recalibrate(told, known)).drop("referenceBases", "referenceSites")
        if every or self.get("binQualityScores"):
            reads = reads.withColumn("qualityScores", bin_qualities("qualityScores", self.get("qualityScoreBinSpec")))
        return reads

    def steps(self) -> list[tuple[str, str]]:
        """What is done to the reads, in order, with the parameters that matter for it."""
        every = self.get("functionalEquivalence")
        done = [("align", " ".join(f"{g}={first}{',' + second if second else ''}" for g, first, second in self.groups))]
        done += [("markDuplicates", "")] * bool(every or self.get("markDuplicates"))
        done += [("recalibrateBaseQualities", self.get("knownSites"))] * bool(every or self.get("recalibrateBaseQualities"))
        done += [("binQualityScores", self.get("qualityScoreBinSpec"))] * bool(every or self.get("binQualityScores"))
        return done

    @property
    def provenance(self) -> str:
        return f"{self.get(self.outputs[0])}/_sample-{self.sample}"

    def execute(self, spark: SparkSession) -> None:
        try:
            alignments.save_reads(self.aligned(spark), self.path)
        finally:
            tables.delete(spark, self.aside)
        chain: list = []
        for program, command in self.steps():
            chain = extend(chain, program, VERSION, command)
        save_chain(spark, chain, self.provenance)
        if self.get("exportBam"):
            rows = spark.read.parquet(self.path)
            head = alignments.sam_header(self.contigs, [{"ID": g[0], "SM": self.sample} for g in self.groups], "coordinate" if self.get("sortOnSave") else "unsorted")
            alignments.write_bam(rows, self.get("bamOutput") or f"{self.path}.bam", head, self.contigs, single=self.get("exportBamAsSingleFile"), sort=self.get("sortOnSave"))


CALL_PARAMS = (
    Param("alignmentOutput", "folder of the aligned reads"), Param("callVariantOutput", "table of the calls"), Param("callVariantOutputVCF", "VCF of the calls", **TEXT), Param("targetedRegions", "interval file", **TEXT), Param("excludedRegions", "interval file", **TEXT),
    Param("minMappingQuality", "reads below it are dropped", int, 20), Param("maxReadStartsPerPosition", "downsampling, 0 for none", int, 50), Param("vcfCompressionCodec", "'', gzip or bgzf", str, ""),
    Param("exportVCF", "also write VCF", bool, False), Param("exportVCFAsSingleFile", "as one file", bool, False), Param("bands", "bounds of genotype-quality bands, comma-separated", str, ""),
)


def target_reads(spark: SparkSession, reads: DataFrame, targets: str | None, excluded: str | None, size: int) -> DataFrame:
    """Reads that overlap the targets less the exclusions; both are honoured wherever reads are called."""
    on = ("referenceName", "start", "end")
    load = lambda p: features.read_features(spark, p).select("referenceName", "start", "end")
    if targets:
        region = oi.subtract(load(targets), load(excluded), on) if excluded else load(targets)
        return oi.overlap_semi_distinct(reads, region, on, on, size)
    if excluded:
        # without targets every read stays but those that lie in an exclusion as a whole
        inside = oi.overlap_pairs(reads.select(*on).distinct(), oi.merge(load(excluded), on).select(F.col("referenceName").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e")), on, ("_c", "_s", "_e"), size)
        # by the alignment's own place: a read may have others elsewhere
        gone = inside.where("start >= _s and `end` <= _e").select(*on).distinct()
        return reads.join(gone, list(on), "left_anti")
    return reads


class CallVariants(Stage):
    """Germline calls of one sample, by the built-in caller if none is given. Only the sample's partition of the table is
    replaced."""

    name = "CallVariants"
    params = CALL_PARAMS
    outputs = ("callVariantOutput",)

    def __init__(self, sample: str, lengths: DataFrame | Callable[[SparkSession], DataFrame], caller: Callable | None = None, schema: str | None = None, **values: object) -> None:
        super().__init__(**values)
        self.sample, self.lengths, self.caller, self.schema = sample, lengths, caller, schema

    def kernel(self) -> tuple[Callable, str]:
        if self.caller:
            return self.caller, self.schema
        return callers.germline_caller(self.sample, reference_confidence=bool(self.get("bands"))), callers.CALLS

    def output_exists(self, spark: SparkSession) -> bool:
        return tables.table_exists(spark, self.get("callVariantOutput"), "sampleId", [self.sample])

    def treatment(self, spark: SparkSession) -> dict[str, object]:
        """What reads go through besides the filter: `after` and `thin` of assembly.preprocessed."""
        return {}

    def calls(self, spark: SparkSession, reads: DataFrame) -> DataFrame:
        s = Settings.of(spark)
        reads = target_reads(spark, reads, self.get("targetedRegions"), self.get("excludedRegions"), s.targetedRegionBinSize)
        reads = assembly.preprocessed(reads, keep=lambda r: ro.quality_filter(r, self.get("minMappingQuality")), most=self.get("maxReadStartsPerPosition"), **self.treatment(spark))
        lengths = self.lengths(spark) if callable(self.lengths) else self.lengths
        return assembly.call_shards(assembly.shards(reads, lengths, s.assemblyBinSize), *self.kernel(), partitions=s.assemblyPartitions or None)

    def save(self, spark: SparkSession, calls: DataFrame, value: str) -> None:
        if bounds := [int(b) for b in self.get("bands").split(",") if b.strip()]:
            calls = vo.banded(calls, bounds)
        named = calls.withColumn("sampleId", F.lit(value))
        target = self.get("callVariantOutputVCF") if self.get("exportVCF") else None
        tables.save_and_export(named, self.get("callVariantOutput"), "sampleId", [value], [value], target, self.get("exportVCFAsSingleFile"), self.get("vcfCompressionCodec"))

    def execute(self, spark: SparkSession) -> None:
        reads = spark.read.parquet(f"{self.get('alignmentOutput')}/sampleId={self.sample}")
        self.save(spark, self.calls(spark, reads), self.sample)


class CallMutations(CallVariants):
    """Somatic calls of a tumour, with a normal if there is one, without sites of a panel of normals."""

    name = "CallMutations"
    params = (*(p for p in CALL_PARAMS if p.name != "alignmentOutput"), Param("alignmentOutputTumor", "reads of the tumour"), Param("alignmentOutputNormal", "reads of the normal", **TEXT), Param("panelOfNormals", "VCF or table of sites", **TEXT), Param("referenceFasta", "FASTA of the reference, for artefacts of palindromes to be clipped", **TEXT), Param("maxSuspiciousReadsPerAlignmentStart", "poorly mapped reads from which on a pile is left out, 0 for none", int, 0), Param("downsamplingStride", "alignment starts that are thinned together", int, 1))

    def __init__(self, pair: str, tumor: str, normal: str | None, lengths: DataFrame | Callable[[SparkSession], DataFrame], caller: Callable | None = None, schema: str | None = None, **values: object) -> None:
        super().__init__(pair, lengths, caller, schema, **values)
        self.tumor, self.normal = tumor, normal

    def treatment(self, spark: SparkSession) -> dict[str, object]:
        clip = lambda reads: somatic.clip_palindromes(reads, fasta.read_fasta(spark, self.get("referenceFasta")))
        thin = lambda reads, most: somatic.thin_piles(reads, most, self.get("maxSuspiciousReadsPerAlignmentStart"), self.get("downsamplingStride"))
        return {"after": [clip] if self.get("referenceFasta") else [], "thin": thin}

    def kernel(self) -> tuple[Callable, str]:
        return (self.caller, self.schema) if self.caller else (callers.somatic_caller(self.tumor, self.normal), callers.SOMATIC)

    def execute(self, spark: SparkSession) -> None:
        reads = spark.read.parquet(f"{self.get('alignmentOutputTumor')}/sampleId={self.tumor}")
        if self.normal:
            reads = reads.unionByName(spark.read.parquet(f"{self.get('alignmentOutputNormal')}/sampleId={self.normal}"))
        calls = self.calls(spark, reads)
        if panel := self.get("panelOfNormals"):
            calls = vo.panel_of_normals(calls, tables.load_variants(spark, panel))
        self.save(spark, calls, self.sample)


class Count(Stage):
    """Reads per transcript of one sample."""

    name = "Count"
    params = (Param("alignmentOutput", "folder of the aligned reads"), Param("quantificationOutput", "folder of the counts"), Param("gtfPath", "gene models"))
    outputs = ("quantificationOutput",)

    def __init__(self, sample: str, **values: object) -> None:
        super().__init__(**values)
        self.sample = sample

    def output_exists(self, spark: SparkSession) -> bool:
        return tables.complete(spark, f"{self.get('quantificationOutput')}/sampleId={self.sample}")

    def execute(self, spark: SparkSession) -> None:
        reads = spark.read.parquet(f"{self.get('alignmentOutput')}/sampleId={self.sample}")
        models = features.read_features(spark, self.get("gtfPath"))
        features.save_features(expression.quantify(models, reads), f"{self.get('quantificationOutput')}/sampleId={self.sample}")


VARIANT_KEYS = ["contigName", "start", "end", "names", "referenceAllele", "alternateAlleles"]


def ingest(spark: SparkSession, paths: list[str], regions: str | None, validate: bool, stringency: str, split: bool = True) -> DataFrame:
    """gVCF rows: region filter (pushed down or joined, same columns either way), one sample a row, checked likelihoods."""
    rows = vcf.read_vcf(spark, paths)
    if regions:
        s = Settings.of(spark)
        f = features.read_features(spark, regions).select("referenceName", "start", "end")
        few = f.limit(s.jointPushdownLimit + 1).collect()
        if len(few) <= s.jointPushdownLimit:
            rows = oi.region_filter(rows, [tuple(r) for r in few])
        else:
            rows = oi.region_join(rows.withColumn("_first", F.get("genotypes", F.lit(0))["sampleId"]), f, keys=[*VARIANT_KEYS, "_first"], size=s.jointRangeJoinBinSize, regions_on=("referenceName", "start", "end")).drop("_first")
    rows = vo.split_samples(rows) if split else rows
    return vo.validate_likelihoods(rows, stringency) if validate else rows


class IngestVariants(Stage):
    """gVCFs to a table of single-sample rows. Without a table path there is nothing to do."""

    name = "IngestVariants"
    params = (
        Param("manifest", "list of gVCFs"), Param("gvcfDeltaOutput", "table of rows", **TEXT), Param("targetedRegions", "interval file", **TEXT), Param("performValidation", "check likelihoods", bool, False),
        Param("validationStringency", "STRICT, LENIENT or SILENT", str, "STRICT"), Param("saveMode", ", ".join(MODES), str, "errorifexists"),
    )

    def output_exists(self, spark: SparkSession) -> bool:
        path = self.get("gvcfDeltaOutput")
        return not path or (self.get("saveMode") != "append" and tables.table_exists(spark, path))

    def execute(self, spark: SparkSession) -> None:
        if path := self.get("gvcfDeltaOutput"):
            paths = manifest.file_list(spark, self.get("manifest"))
            rows = ingest(spark, paths, self.get("targetedRegions"), self.get("performValidation"), self.get("validationStringency"))
            tables.save(rows.coalesce(Settings.of(spark).ingestPartitions), path, self.get("saveMode"))


class JointlyCallVariants(Stage):
    """Joint calls from the ingested table, or from gVCFs where there is none (then regions and validation apply here)."""

    name = "JointlyCallVariants"
    params = (
        Param("manifest", "list of gVCFs", **TEXT), Param("gvcfDeltaOutput", "table of rows", **TEXT), Param("callVariantOutput", "table of the calls", **TEXT), Param("callVariantOutputVCF", "VCF of the calls", **TEXT), Param("targetedRegions", "interval file", **TEXT),
        Param("performValidation", "check likelihoods", bool, False), Param("validationStringency", "STRICT, LENIENT or SILENT", str, "STRICT"), Param("exportVCF", "also write VCF", bool, False), Param("exportVCFAsSingleFile", "as one file", bool, True), Param("vcfCompressionCodec", "'', gzip or bgzf", str, ""),
    )

    def rows(self, spark: SparkSession) -> tuple[DataFrame, list[str]]:
        table, listed = self.get("gvcfDeltaOutput"), self.get("manifest")
        if not table and not listed:
            raise ValueError("joint calling needs a table of rows or a list of gVCFs")
        paths = manifest.file_list(spark, listed) if listed else []
        if table:
            rows = spark.read.parquet(table)
            if paths:
                return rows, vcf.sample_ids(spark, paths)
            return rows, [r.s for r in rows.select(F.get("genotypes", F.lit(0))["sampleId"].alias("s")).distinct().orderBy("s").collect()]
        return ingest(spark, paths, self.get("targetedRegions"), self.get("performValidation"), self.get("validationStringency")), vcf.sample_ids(spark, paths)

    def execute(self, spark: SparkSession) -> None:
        s, own = Settings.of(spark), own_session(spark)  # whose number of partitions nobody else sees
        if s.jointShufflePartitions:
            own.conf.set("spark.sql.shuffle.partitions", str(s.jointShufflePartitions))
        rows, samples = self.rows(own)
        self.finish(own, genotyping.genotype(rows, samples, s.jointBinSize, s.jointBinPartitions or None, s.jointMaxAltAlleles), samples)

    def finish(self, spark: SparkSession, called: DataFrame, samples: list[str]) -> None:
        if path := self.get("callVariantOutput"):
            tables.save(called, path, "overwrite")
            called = spark.read.parquet(path)
        if self.get("exportVCF"):
            write = vcf.write_single if self.get("exportVCFAsSingleFile") else vcf.write_sharded
            write(called, self.get("callVariantOutputVCF"), samples, codec=self.get("vcfCompressionCodec"))


def batch_aligner(spark: SparkSession, kernel: Callable[[list[dict]], list[dict]], schema: str) -> Aligner:
    """An aligner that calls `kernel` on batches of the session's alignerBatchBases bases."""
    most = Settings.of(spark).alignerBatchBases
    return lambda raw: kernels.batched(raw, kernel, schema, most)


def joint_pipeline() -> Pipeline:
    return Pipeline("JointGenotyping", [IngestVariants(), JointlyCallVariants()])


def _samples(spark: SparkSession, sheet: str) -> list[tuple[str, object]]:
    rows = manifest.load_samples(spark, sheet).orderBy("sample_id").collect()  # one row a sample of the sheet
    return [(r.sample_id, [(g.read_group_id, g.input, g.secondInput) for g in r.read_groups]) for r in rows]


def germline_pipeline(aligner: Aligner, lengths: Callable[[SparkSession], DataFrame], caller: Callable | None = None, schema: str | None = None, align: bool = True, call: bool = True) -> MultiSample:
    def delegate(info: tuple[str, list]) -> Pipeline:
        sample, groups = info
        return Pipeline("DNASeq", stages_of(align, call, lambda: Align(sample, groups, aligner), lambda: CallVariants(sample, lengths, caller, schema)))

    return MultiSample("DNASeq", lambda spark, sheet: [(s, (s, g)) for s, g in _samples(spark, sheet)], delegate)


def expression_pipeline(aligner: Aligner, align: bool = True, call: bool = True) -> MultiSample:
    def delegate(info: tuple[str, list]) -> Pipeline:
        sample, groups = info
        return Pipeline("RNASeq", stages_of(align, call, lambda: Align(sample, groups, aligner), lambda: Count(sample)))

    return MultiSample("RNASeq", lambda spark, sheet: [(s, (s, g)) for s, g in _samples(spark, sheet)], delegate)


def split_pair(samples: list[tuple[str, str, list]]) -> tuple[tuple[str, list], tuple[str, list] | None]:
    """(tumour, normal or None) of a pair's (label, sample, groups); exactly one tumour, at most one normal."""
    tumors = [x[1:] for x in samples if x[0].lower() == "tumor"]
    normals = [x[1:] for x in samples if x[0].lower() == "normal"]
    if len(tumors) != 1 or len(normals) > 1 or len(tumors) + len(normals) != len(samples):
        raise ValueError("a pair needs exactly one tumor and at most one normal")
    return tumors[0], normals[0] if normals else None


def somatic_pipeline(aligner: Aligner, lengths: Callable[[SparkSession], DataFrame], caller: Callable | None = None, schema: str | None = None) -> MultiSample:
    def listed(spark: SparkSession, sheet: str) -> list[tuple[str, object]]:
        rows = manifest.load_pairs(spark, sheet).orderBy("pair_id").collect()
        return [(r.pair_id, (r.pair_id, [(s.label, s.sample_id, [(g.read_group_id, g.input, g.secondInput) for g in s.read_groups]) for s in r.samples])) for r in rows]

    def delegate(info: tuple[str, list]) -> Pipeline:
        pair, samples = info
        tumor, normal = split_pair(samples)
        aligns = [Align(*normal, aligner, suffix="Normal")] if normal else []
        return Pipeline("MutSeq", [*aligns, Align(*tumor, aligner, suffix="Tumor"), CallMutations(pair, tumor[0], normal[0] if normal else None, lengths, caller, schema)])

    return MultiSample("MutSeq", listed, delegate)


tumor_normal_pipeline = somatic_pipeline
