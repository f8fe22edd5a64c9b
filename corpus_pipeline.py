"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. quality      documents that the classifier rejects go
2. near_dedup   one document of each SimHash group stays
3. benchmark    documents that the contamination rule marks go
4. secrets      secrets in texts are replaced by ``[SECRET]``; no document goes
5. mixture      every document with the words that the mix takes of it

All stages but the last return the columns of ``documents``. Each works on all that
its predecessor kept and fits its models and statistics on its own input.

Columns that no stage reads may have any names, those of the operators' results too: stages
see them under other names. Null or empty texts: judged by the classifier like any
other, near duplicates of each other, never contaminated, without secrets, of size 0. Null
ids are unlabelled; of a group the smallest id stays that is not null. Null sources are one source, last.
Repeated rows are near duplicates, so one of them stays. An empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone.llm import decontaminate, mixing, quality, secrets, simhash
from dialtone.llm.common import bound_arrow_batches, read_table, remainder, shared_folder


READ = ("doc_id", "text", "source", "n_chars")


def _own_names(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` on ``docs`` whose columns that it doesn't read bear names that no result has."""
    mark = "_own"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark = "_" + mark
    names = [c if c in READ else f"{mark}{i}" for i, c in enumerate(docs.columns)]
    return stage(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    train = remainder(F.col("doc_id"), 5) != 0
    model = quality.fit(docs.where(train), read_table(spark, sf_dir, "labels").where(train))
    return _own_names(docs, lambda d: quality.classify(d, model).where("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = secrets.train(docs)

    def masked(d: DataFrame) -> DataFrame:
        clean = secrets.scan(d, model).withColumn("text", F.col("redacted"))
        if "n_chars" in d.columns:  # the length of the text, also after masking
            clean = clean.withColumn("n_chars", F.when(F.col("n_secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        return clean

    return _own_names(docs, masked)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's target and the words the mix takes."""
    found = mixing.taken(mixing.plan(docs, ["doc_id"]))
    return found.select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", select_quality),
    ("near_dedup", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("secrets", mask_secrets),
    ("mixture", mix_sources),
]

#: Trained classifiers and connected components are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder, and goes
    when the next one is written."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        before = path
    return docs
