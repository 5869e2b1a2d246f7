"""Commands of annotation programs."""

from __future__ import annotations

import pytest

from helixframe.plans import annotate


def option(command: list[str], name: str) -> str:
    return command[command.index(name) + 1]


@pytest.mark.parametrize(("genome", "assembly", "transcripts"), [(g, a, t) for g, (a, t) in annotate.VEP.items()])
def test_vep_of_every_genome(genome, assembly, transcripts):
    command = annotate.vep_command(genome.upper(), "/f/ref.fa")
    assert command[0] == annotate.VEP_PROGRAM
    assert option(command, "--assembly") == assembly and option(command, "--fasta") == "/f/ref.fa"
    assert option(command, "--dir_cache") == f"/genomes/{genome}" and option(command, "--format") == "vcf"
    assert [x for x in command if x in ("--refseq", "--merged")] == ([transcripts] if transcripts else [])
    assert command[-2:] == ["--fork", "4"]


def test_vep_options():
    command = annotate.vep_command("grch38_vep_96", "r.fa", cache="/c", program="vep", extra="--fork 8 --plugin 'A B'")
    assert command[0] == "vep" and option(command, "--dir_cache") == "/c"
    assert command[-4:] == ["--fork", "8", "--plugin", "A B"]
    assert annotate.vep_command("grch38_vep_96", "r.fa", extra="")[-1] == "--vcf"


@pytest.mark.parametrize("extra", ["--cache", "--fork 2 --assembly GRCh37", "--format=ensembl"])
def test_own_options_are_not_overridden(extra):
    with pytest.raises(ValueError, match="set by the command itself"):
        annotate.vep_command("grch37_vep_96", "r.fa", extra=extra)


@pytest.mark.parametrize("genome", ["grch38", "", None])
def test_genomes_without_a_cache(genome):
    with pytest.raises(ValueError, match="VEP knows no reference genome"):
        annotate.vep_command(genome, "r.fa")


def test_snpeff():
    assert [annotate.snpeff_database(g) for g in ("grch37", "GRCh38")] == ["GRCh37.75", "GRCh38.86"]
    assert annotate.snpeff_database("other", "mine") == "mine"
    assert annotate.snpeff_folder("grch38") == "/genomes/grch38/snpEff" and annotate.snpeff_folder("grch38", "/s") == "/s"
    with pytest.raises(ValueError, match="SnpEff knows no reference genome"):
        annotate.snpeff_database("other")


def test_parameters():
    by_name = {p.name: p for p in (*annotate.VEP_PARAMS, *annotate.SNPEFF_PARAMS)}
    assert set(by_name) == {"annotationOutput", "annotationOutputVCF", "vepCache", "vepCmd", "extraVepOptions", "snpEffDB", "snpEff"}
    assert not any(p.required for p in by_name.values())
