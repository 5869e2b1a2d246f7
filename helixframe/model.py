"""Schemas of reads, fragments, variants, features and manifests."""

from __future__ import annotations

from pyspark.sql import types as T

NAMED = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "binary": T.BinaryType()}


def flat(ddl: str) -> T.StructType:
    """A schema of plain columns, made without a session."""
    pairs = (x.split() for x in ddl.split(","))
    return T.StructType([T.StructField(name, NAMED[kind]) for name, kind in pairs])


#: The fields of a read in order.
READ = flat(
    "readInFragment int, referenceName string, start bigint, originalStart bigint, end bigint, mappingQuality int, readName string, "
    "sequence string, qualityScores string, cigar string, originalCigar string, basesTrimmedFromStart int, basesTrimmedFromEnd int, "
    "readPaired boolean, properPair boolean, readMapped boolean, mateMapped boolean, failedVendorQualityChecks boolean, "
    "duplicateRead boolean, readNegativeStrand boolean, mateNegativeStrand boolean, primaryAlignment boolean, secondaryAlignment boolean, "
    "supplementaryAlignment boolean, mismatchingPositions string, originalQualityScores string, attributes string, readGroupId string, "
    "readGroupSampleId string, mateAlignmentStart bigint, mateReferenceName string, insertSize bigint"
)
RAW_READ = flat("readName string, readInFragment int, sequence binary, qualityScores string")
FEATURE = flat("referenceName string, start bigint, end bigint, name string, featureType string, source string, score double, strand string, geneId string, transcriptId string, exonId string")
SAMPLE_SHEET = ("file_path", "sample_id", "paired_end", "read_group_id")
PAIR_SHEET = ("pair_id", "file_path", "sample_id", "label", "paired_end", "read_group_id")
