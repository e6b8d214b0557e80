"""A training corpus from raw documents: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before
kept. All but the last return the columns of ``documents``. The mixture's order lies
in its files: the last stage numbers rows by file and row, where the reader knows
them, so token files follow the schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from relaysql.llm.common import table, written
from relaysql.llm.decontaminate import remove_contaminated
from relaysql.llm.mixing import mixed_documents
from relaysql.llm.ngram_join import similar_documents
from relaysql.llm.quality_rules import quality_filter
from relaysql.llm.token_files import read_token_files, write_token_files
from relaysql.session import shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies (five words,
    0.8); rows without an id or without words belong to no group. Rows that share an id
    are told apart by their texts: unlike ones all stay, of equal ones one stays."""
    shared = written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select("doc_id"), "pipeline-shared-ids")
    if shared.isEmpty():
        found = written(similar_documents(docs, shingle_words=5, percent=80), "pipeline-components")
        gone = found.where("doc_id <> component_id").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    own = F.when(F.col("_shared"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id"))
    nodes = written(docs.join(shared.withColumn("_shared", F.lit(True)), "doc_id", "left").withColumn("_node", own), "pipeline-nodes")
    found = written(similar_documents(nodes, id_col="_node", shingle_words=5, percent=80).where("doc_id is not null and n_shingles > 0").select(
        F.col("doc_id").alias("_node"), F.col("component_id").alias("_group")).distinct(), "pipeline-components")
    first = found.join(nodes.select("_node", "doc_id").distinct(), "_node").groupBy("_group").agg(
        F.min(F.struct("doc_id", "_node")).alias("r")).select(F.col("r._node").alias("_node"))
    gone = written(found.join(first, "_node", "left_anti").select("_node"), "pipeline-copies")
    kept = nodes.join(gone, "_node", "left_anti")
    grouped = kept.where("_shared").join(found.select("_node"), "_node", "left_semi").dropDuplicates(["_node"])
    wordless = kept.where("_shared").join(found.select("_node"), "_node", "left_anti")
    rest = kept.where("_shared IS NULL")
    return grouped.unionByName(wordless).unionByName(rest).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture, each as often as it is used."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture; returns what they hold per document."""
    try:
        placed = docs.select("doc_id", "text", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"),
                             F.col("_metadata.row_index").alias("line"))
        order = ("file", "line")
    except AnalysisException:                      # not read from files: by id
        placed, order = docs, ()
    path = write_token_files(placed, shared_path(spark, "llm", "pipeline-tokens"), order=order)
    return read_token_files(spark, path)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
    ("token_files", token_files),
]

ORACLE_SQL = None                                  # SQL cannot express the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
