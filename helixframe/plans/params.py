"""Typed, named parameters of stages."""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Any

#: Prebuilt reference genomes by id, name to look for under the genomes folder.
GENOMES = {"grch37": "human_g1k_v37", "grch37_star": "human_g1k_v37", "grch37_merge": "human_g1k_v37", "grch38": "GRCh38_full_analysis_set_plus_decoy_hla", "grch38_star": "GRCh38_full_analysis_set_plus_decoy_hla", "grch38_merge": "GRCh38_full_analysis_set_plus_decoy_hla"}
REPLAY = ("overwrite", "skip")
UNITS = {"s": 1, "sec": 1, "second": 1, "seconds": 1, "m": 60, "min": 60, "minute": 60, "minutes": 60, "h": 3600, "hour": 3600, "hours": 3600, "d": 86400, "day": 86400, "days": 86400}


@dataclass(frozen=True)
class Param:
    name: str
    doc: str = ""
    kind: type = str
    default: Any = None
    optional: bool = False
    visible: bool = True

    @property
    def required(self) -> bool:
        return self.default is None and not self.optional

    def coerce(self, value: Any) -> Any:
        """A value of the parameter's kind; text is read as that kind."""
        if value is None or isinstance(value, self.kind) and not (self.kind is int and isinstance(value, bool)):
            return value
        if self.kind is bool:
            if isinstance(value, str) and value.strip().lower() in ("true", "false"):
                return value.strip().lower() == "true"
            raise ValueError(f"{self.name}: {value!r} is not true or false")
        if self.kind in (int, float, str) and isinstance(value, (str, int, float)):
            return self.kind(value)
        raise ValueError(f"{self.name}: {value!r} is not of type {self.kind.__name__}")


def seconds(text: str) -> float:
    """A duration such as 12h or '30 min'; the unit must be given."""
    import re

    m = re.fullmatch(r"\s*([0-9.]+)\s*([A-Za-z]+)\s*", text)
    if not m or m[2].lower() not in UNITS:
        raise ValueError(f"a duration needs a number and a unit: {text!r}")
    return float(m[1]) * UNITS[m[2].lower()]


def reference_genome(path: str | None = None, genome: str | None = None, folder: str = "/genomes") -> tuple[str, str]:
    """(FASTA path, name): an explicit path first, then the environment's refGenomePath, then a prebuilt id, of which
    refGenomeId in the environment is the default."""
    path = path or os.environ.get("refGenomePath")
    if path:
        return path, os.path.basename(path).removesuffix(".fasta").removesuffix(".fa")
    genome = genome or os.environ.get("refGenomeId")
    if genome is None or genome.lower() not in GENOMES:
        raise ValueError(f"unknown reference genome {genome!r}; known: {', '.join(sorted(GENOMES))}")
    name = GENOMES[genome.lower()]
    return f"{folder}/{genome.lower()}/data/{name}.fa", name


@dataclass(frozen=True)
class Settings:
    """Tunables of the engine; each can be overridden in the session as helix.<name>. Numbers of partitions of 0 are left to
    the session (spark.sql.shuffle.partitions and adaptive execution)."""

    assemblyBinSize: int = 5000
    assemblyPartitions: int = 0
    markDuplicatesPartitions: int = 0
    jointBinSize: int = 5000
    jointPushdownLimit: int = 25
    jointBinPartitions: int = 0
    jointShufflePartitions: int = 0
    jointRangeJoinBinSize: int = 1000
    jointMaxAltAlleles: int = 49
    concurrentSamples: int = 1
    ingestPartitions: int = 3000
    alignmentPartitions: int = 0
    alignmentMinPartitions: int = 0
    alignerBatchBases: int = 1_000_000
    targetedRegionBinSize: int = 1000

    @classmethod
    def of(cls, spark) -> Settings:  # noqa: ANN001
        base = cls()
        return cls(**{k: type(v)(spark.conf.get(f"helix.{k}", str(v))) for k, v in base.__dict__.items()})
