"""Corpus pipeline: quality rules, language identification, near duplicates, personal data, packing.

Every stage takes the documents that its predecessor kept and writes its own. All but the last return the columns of
documents; other columns that the input has are left out. Each stage says what becomes of nulls, ties and repeated rows; an
empty table gives an empty one in all of them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.langid import UNKNOWN, identify, train
from gridweave.llm.ngram_join import ngram_components
from gridweave.llm.online_packing import pack_online
from gridweave.llm.pii import mask_personal
from gridweave.llm.quality import apply_quality_rules
from gridweave.llm.queries import tokenizer_path
from gridweave.llm.spark_util import cut, importable, release, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text of which the best language holds less than this share is rejected.
LEAST_SHARE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that are too frequent on their host; n_chars follows.

    Null, empty and short texts are rejected. A null source is a host of its own. Repeated rows count one by one, and are
    kept or rejected alike."""
    importable(spark)
    return apply_quality_rules(docs.select(*COLUMNS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which lang then names; learned from the labels that come in.

    Texts that are null or without a letter are rejected, as are those of which the best language holds under
    ``LEAST_SHARE`` of the letters; of equally good languages the first by name counts. Without any label nothing is learned and
    every document goes. Repeated rows and null ids are told alike."""
    importable(spark)
    told = identify(docs.select(*COLUMNS), train(docs))
    kept = told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select(*(F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in COLUMNS))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, the same in every job, whatever executors come and go: the file and the place in it; of documents that
    aren't read from files, numbers that are written down with them."""
    try:
        return docs.select(*COLUMNS, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")).alias("row"))
    except AnalysisException:
        return cut(docs.select(*COLUMNS, F.struct(F.lit(0).cast("bigint").alias("file"), F.monotonically_increasing_id().alias("place")).alias("row")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id (null ids last, of equal ids the first row).

    Rows are told apart by their place, so repeated rows and ids are members of a group like others. Null, empty and blank
    texts have no group, and all stay."""
    importable(spark)
    rows = _numbered(docs)
    groups = ngram_components(rows, doc_id="row").select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    ids = rows.select("row", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row").alias("place"))
    kept = groups.join(ids, "row").groupBy("component").agg(F.min("place").alias("place")).select("place.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by signs; n_chars follows. Null and empty texts stay as they are, with n_chars 0;
    repeated rows and null ids are treated alike."""
    masked = mask_personal(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of up to 1024 tokens. Null and empty texts are one end token; repeated
    rows and null ids are packed one by one."""
    importable(spark)
    return pack_online(docs, tokenizer_path())


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", packing)]

#: Trained language scores, Viterbi paths and token ids are beyond SQL; tests/llm holds every stage to a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again. Folders of stages stay until the
    result, which reads the last, is no longer needed: clearing them is the caller's."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        release(spark)
    return docs
