"""Scores of a run against an evaluation set, and comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text


def latest_per_key(
    df: DataFrame, keys: list[str], version_col: str, tie_break: str
) -> DataFrame:
    """The row with the highest version per key; "10" comes after "9"."""
    version = F.struct(F.col(version_col).cast("long"), F.col(tie_break))
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), version).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def latest_version(df: DataFrame, version_col: str, default: int = 1) -> DataFrame:
    """One row with the highest version, at least ``default``."""
    highest = F.greatest(F.max(F.col(version_col).cast("long")), F.lit(default).cast("long"))
    return df.agg(highest.alias("version"))


def _words(text: Column) -> Column:
    cleaned = clean_text(F.lower(F.coalesce(text, F.lit(""))))
    return F.filter(F.split(cleaned, " "), lambda word: word != "")


def word_overlap(pairs: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """``(keys, common, left_words, right_words)``: sizes of the word multisets.

    Words are counted per key and word before they meet, so a long text or a
    frequent word weighs on no single task.
    """

    def tagged(column: str, in_left: int) -> Column:
        return F.transform(
            _words(F.col(column)),
            lambda word: F.struct(
                word.alias("word"),
                F.lit(in_left).alias("in_left"),
                F.lit(1 - in_left).alias("in_right"),
            ),
        )

    words = pairs.select(
        *keys, F.explode(F.concat(tagged(left, 1), tagged(right, 0))).alias("w")
    ).select(*keys, "w.*")
    counts = words.groupBy(*keys, "word").agg(
        F.sum("in_left").alias("n_left"), F.sum("in_right").alias("n_right")
    )
    return counts.groupBy(*keys).agg(
        F.sum(F.least("n_left", "n_right")).alias("common"),
        F.sum("n_left").alias("left_words"),
        F.sum("n_right").alias("right_words"),
    )


def answer_scores(eval_rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Exact match and word F1 per evaluation row that expects a response.

    Without an answer both are 0.
    """
    pair = ["request_id", "expected_hash"]
    pairs = (
        eval_rows.where(F.col("expected_response").isNotNull())
        .select("request_id", "expected_hash", "expected_response")
        .distinct()
        .join(answers.select("request_id", "answer"), "request_id", "left")
    )
    overlap = word_overlap(pairs, pair, "answer", "expected_response")
    words = F.col("left_words") + F.col("right_words")
    return (
        pairs.withColumn(
            "exact_match", (F.col("answer") == F.col("expected_response")).cast("double")
        )
        .drop("answer", "expected_response")
        .join(overlap, pair, "left")
        .select(
            *pair,
            F.coalesce("exact_match", F.lit(0.0)).alias("exact_match"),
            F.coalesce(2 * F.col("common") / words, F.lit(0.0)).alias("token_f1"),
        )
    )


def retrieval_scores(hits: DataFrame, expected: DataFrame) -> DataFrame:
    """Recall and precision per request that has expected passages.

    ``hits`` is ``(request_id, doc_uri)`` of the k retrieved passages.
    """
    retrieved = hits.select("request_id", "doc_uri").distinct()
    sides = expected.select("request_id", "doc_uri", F.lit(1).alias("e"), F.lit(0).alias("r"))
    sides = sides.unionByName(
        retrieved.select("request_id", "doc_uri", F.lit(0).alias("e"), F.lit(1).alias("r"))
    )
    per_document = sides.groupBy("request_id", "doc_uri").agg(
        F.max("e").alias("e"), F.max("r").alias("r")
    )
    return (
        per_document.groupBy("request_id")
        .agg(
            F.sum("e").alias("expected"),
            F.sum("r").alias("retrieved"),
            F.sum(F.col("e") * F.col("r")).alias("both"),
        )
        .where(F.col("expected") > 0)
        .select(
            "request_id",
            (F.col("both") / F.col("expected")).alias("recall_at_k"),
            F.when(F.col("retrieved") > 0, F.col("both") / F.col("retrieved"))
            .otherwise(F.lit(0.0))
            .alias("precision_at_k"),
        )
    )


def eval_metrics(
    evaluation: DataFrame, answers: DataFrame, hits: DataFrame, expected: DataFrame
) -> DataFrame:
    """``(type, metric, value)``: means over the rows of every type.

    ``answers`` is ``(request_id, answer)``, ``hits`` and ``expected`` are
    ``(request_id, doc_uri)``. Rows without the thing to compare with do not
    count for that metric.
    """
    rows = (
        evaluation.withColumn(
            "expected_hash", F.md5(F.coalesce("expected_response", F.lit("")))
        )
        .groupBy("request_id", "type", "expected_hash", "expected_response")
        .agg(F.count("*").alias("n"))
    )
    scored = (
        rows.drop("expected_response")
        .join(answer_scores(rows, answers), ["request_id", "expected_hash"], "left")
        .join(retrieval_scores(hits, expected), "request_id", "left")
    )
    names = ["exact_match", "token_f1", "recall_at_k", "precision_at_k"]

    def mean(name: str) -> Column:
        weight = F.sum(F.when(F.col(name).isNotNull(), F.col("n")))
        return F.round(F.sum(F.col(name) * F.col("n")) / weight, 6).alias(name)

    wide = scored.groupBy("type").agg(
        F.sum("n").cast("double").alias("rows"), *[mean(name) for name in names]
    )
    return wide.unpivot("type", ["rows", *names], "metric", "value")


def eval_compare(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Change of every metric since an earlier run; a lower score is a regression.

    The number of rows is compared, but fewer rows are no worse.
    """
    now = current.select("type", "metric", F.col("value").alias("current_value"))
    then = previous.select("type", "metric", F.col("value").alias("previous_value"))
    delta = F.round(F.col("current_value") - F.col("previous_value"), 6)
    return (
        now.join(then, ["type", "metric"], "full")
        .withColumn("delta", delta)
        .withColumn("regressed", F.coalesce((F.col("delta") < 0) & (F.col("metric") != "rows"), F.lit(False)))
    )
