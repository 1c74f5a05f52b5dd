"""Documents made ready for training: toxic ones go, one of each group of near copies
stays, secrets are masked, sources are mixed to their weights, the rest is packed.

``STAGES`` lists the steps. Each takes ``(spark, docs, sf_dir)``, works on all rows it is
given and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bottom_k, mixing, packing, secret_scan, toxicity
from corpusloom.session import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Stages share their Python workers, which keep what any of them has taken: texts in an Arrow
# batch, and words whose ids the packing keeps.
BATCH_ROWS, WORDS_KEPT = 1_024, 250_000
# No SQL says what trained models find; the stages are tested against plain Python.
ORACLE_SQL = None


def bound_batches(spark: SparkSession) -> None:
    """At most ``BATCH_ROWS`` texts in an Arrow batch from now on in this session.

    A stage is computed when its rows are read, so the setting has to outlast the call.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject; null and empty texts stay."""
    bound_batches(spark)
    model = toxicity.train_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_severity(docs.select(*COLUMNS), model)
    return scored.where(~F.col("toxic")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies; null and empty texts are no copies and stay."""
    return bottom_k.one_of_each(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and their length counted anew; a null text stays one."""
    bound_batches(spark)
    network = secret_scan.train_on_documents(docs)
    masked = secret_scan.without_secrets(docs.select(*COLUMNS), network)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes their words; null texts have none."""
    mixed = mixing.mixed_texts(docs.select(*COLUMNS))
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in packed sequences, with their ids; a null text is its end id."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, words_kept=WORDS_KEPT)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each_group),
    ("secrets", mask_secrets),
    ("source_mix", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
