"""Parameters and commands of variant annotation programs (VEP, SnpEff). No stage runs them; `vep_command` is what a caller
would hand to a process that reads VCF on its input and writes VCF."""

from __future__ import annotations

import shlex

from helixframe.plans.params import Param

#: SnpEff's database of a reference genome.
SNPEFF = {"grch37": "GRCh37.75", "grch38": "GRCh38.86"}
#: VEP's assembly and choice of transcripts for a genome with its cache.
VEP = {
    "grch37_vep_96": ("GRCh37", None),
    "grch37_refseq_vep_96": ("GRCh37", "--refseq"),
    "grch37_merged_vep_96": ("GRCh37", "--merged"),
    "grch38_vep_96": ("GRCh38", None),
    "grch38_refseq_vep_96": ("GRCh38", "--refseq"),
    "grch38_merged_vep_96": ("GRCh38", "--merged"),
}
VEP_PROGRAM = "/opt/vep/src/ensembl-vep/vep"
EXTRA = "--everything --minimal --allele_number --fork 4"
#: Options that are set here; a value in `extraVepOptions` would say something else.
OWN = ("--assembly", "--cache", "--dir_cache", "--fasta", "--format", "--merged", "--no_stats", "--offline", "--output_file", "--refseq", "--vcf")

OUTPUT_PARAMS = (Param("annotationOutput", "table of annotated variants", optional=True), Param("annotationOutputVCF", "VCF of annotated variants", optional=True))
SNPEFF_PARAMS = (*OUTPUT_PARAMS, Param("snpEffDB", "SnpEff database, by default that of the genome", optional=True), Param("snpEff", "folder of SnpEff databases", optional=True))
VEP_PARAMS = (
    *OUTPUT_PARAMS, Param("vepCache", "folder of VEP's cache", optional=True), Param("vepCmd", "VEP program", default=VEP_PROGRAM),
    Param("extraVepOptions", f"more options of VEP, none of {', '.join(OWN)}", default=EXTRA),
)


def known(table: dict, genome: str | None, program: str):  # noqa: ANN201
    if genome is None or genome.lower() not in table:
        raise ValueError(f"{program} knows no reference genome {genome!r}; known: {', '.join(sorted(table))}")
    return table[genome.lower()]


def snpeff_database(genome: str | None, database: str | None = None) -> str:
    """The database that is named, else the genome's; an unknown genome is an error."""
    return database or known(SNPEFF, genome, "SnpEff")


def snpeff_folder(genome: str, path: str | None = None, folder: str = "/genomes") -> str:
    return path or f"{folder}/{genome.lower()}/snpEff"


def vep_command(genome: str, fasta: str, cache: str | None = None, program: str = VEP_PROGRAM, extra: str = EXTRA, folder: str = "/genomes") -> list[str]:
    """VEP over VCF, offline and without statistics. The cache is by default the genome's folder. An unknown genome is an
    error, and so is an extra option that is set here already."""
    assembly, transcripts = known(VEP, genome, "VEP")
    more = shlex.split(extra)
    if twice := sorted({x.split("=")[0] for x in more} & set(OWN)):
        raise ValueError(f"set by the command itself: {', '.join(twice)}")
    where = ["--dir_cache", cache or f"{folder}/{genome.lower()}", "--fasta", fasta, "--assembly", assembly]
    form = ["--no_stats", "--cache", "--offline", "--format", "vcf", "--output_file", "STDOUT", "--vcf"]
    return [program, *where, *form, *([transcripts] if transcripts else []), *more]
