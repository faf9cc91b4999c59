"""The corpus pipeline: quality, near copies, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all rows the one before kept and
returns a DataFrame; all but the last return the columns of ``documents``.
Between stages rows are written to the shared folder and read again.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import classifier, mixing, packing, secrets, simhash
from muster.llm.common import cut, table
from muster.session import shared_folder

MAX_PASSES = 2.0  # of any source in the mix


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject. It learns from the labelled ones among all documents."""
    model = classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    columns = docs.columns
    scored = classifier.score(docs, model, keep=[c for c in columns if c != "doc_id"])
    return scored.where("predicted = 1").select(*columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one of the smallest id; a null id comes last,
    and among equal ids a hash of the row decides. Near copies are those of the SimHash operator:
    4-word shingles, fingerprints that differ in 4 bits at most, directly or over others. Rows are
    told apart by 128 bits of hashes of all columns, not by id: different texts under one id, or
    under null ids, all stay. Equal rows are one."""
    # a hash passes over nulls, so the flags tell which columns they are in
    columns = [*docs.columns, *[F.col(c).isNull() for c in docs.columns]]
    mark = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(*columns).alias("h"),
                    F.xxhash64(F.lit("row"), *columns).alias("i"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), mark.alias("mark"))
    marks = cut(simhash.fingerprints(rows.select("mark", "row.text"), key="mark"))
    least = marks.groupBy("fp").agg(F.min("key").alias("least")).join(simhash.linked(marks), "fp")
    kept = least.groupBy("root").agg(F.min("least").alias("least")).select("least.h", "least.i")
    met = rows.join(kept, (rows["mark.h"] == kept["h"]) & (rows["mark.i"] == kept["i"]), "left_semi")
    # what the join leaves of a group are repeats of one row
    return met.select("row", "mark.h", "mark.i").dropDuplicates(["h", "i"]).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked; n_chars follows the text."""
    rows = secrets.find_secrets(docs.select(F.struct(*docs.columns).alias("row"), "text"), key="row")
    row = F.col("row").withField("text", F.col("redacted")).withField("n_chars", F.length("redacted").cast("long"))
    return rows.select(row.alias("row")).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As even a mix of the sources as ``MAX_PASSES`` over the smallest allows; a row per pass."""
    return mixing.mix(docs, max_passes=MAX_PASSES).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mixture),
    ("packing", packed),
]
ORACLE_SQL = None  # a trained model and a tokenizer are beyond SQL; tests hold stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
