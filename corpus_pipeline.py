"""Corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input.

Every stage works on all documents that its predecessor kept, and all but the last return the columns of documents.
Very long texts are worked on whole. Ties: of linked documents the smallest doc_id stays, of rows that share a doc_id the smallest text (then
source, lang and n_chars); a score equal to the cut is kept, a coverage equal to the share goes. Null texts stay null where a stage keeps them; repeated rows are judged each, except that the n-gram Jaccard join keeps one
row of each group; empty tables give empty results; columns beyond those of documents are dropped by the first stage.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import decontaminate, jaccard, packing, quality, secrets
from helixframe.llm.common import fresh_path, remove_path, table, written
from helixframe.session import ship

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def documents(docs: DataFrame) -> DataFrame:
    """The columns of documents in their types; a column that is missing is null."""
    types = {"doc_id": "long", "n_chars": "long"}
    return docs.select(*((F.col(c) if c in docs.columns else F.lit(None)).cast(types.get(c, "string")).alias(c) for c in DOCUMENT))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rules or the trees reject go."""
    return quality.keep(documents(docs), table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five-word shingles at 0.8: of each group the document of the smallest doc_id stays, and of
    rows that share a doc_id that of the smallest text. Documents without words are linked with nothing and all stay."""
    docs = documents(docs)
    found = jaccard.jaccard_components(docs, k=5, percent=80)
    others = found.where("n_shingles > 0 and component_id <> doc_id").select("doc_id").distinct()
    first = docs.hint("merge").join(others, "doc_id", "left_anti")  # ids of copies grow with the corpus: never broadcast
    repeated = written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return first.select(*DOCUMENT)
    first = written(first.select(*DOCUMENT), "first")  # read twice
    order = ("text", "source", "lang", "n_chars")
    one = first.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*order)).alias("row")).select("doc_id", "row.*")
    return first.hint("merge").join(repeated, "doc_id", "left_anti").select(*DOCUMENT).unionByName(one.select(*DOCUMENT))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that cover half of a test item go."""
    return decontaminate.clean(documents(docs), table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret in a text is replaced by a mark; n_chars follows."""
    return secrets.redact(documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents into sequences of 1024 tokens: a row for each piece."""
    import public_tokenizers

    return packing.pack_documents(documents(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]
#: Trees and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-').lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
