"""From assessment and request logs to evaluation sets.

An assessment log row is ``(request_id, source struct<id>, timestamp, step_id,
text_assessment struct<ratings map, suggested_output>, retrieval_assessment
struct, schema_version, ...)``; a request log row is ``(<key>, request, response)``
with unique ids in the column that the caller names as ``key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.joins import full_join_many, left_join_many

# The rating that decides, its verdicts, the labels of the set.
RATING = "answer_correct"
POSITIVE, NEGATIVE = "positive", "negative"
THUMBS_UP, THUMBS_DOWN = "thumbs_up", "thumbs_down"
NO_FEEDBACK = "no_feedback_provided"


def latest_text_assessment(
    log: DataFrame, tie_break: str, keys: tuple[str, ...] = ("request_id",)
) -> DataFrame:
    """The newest text assessment per key, without the retrieval columns.

    By default one per request, so that a second reviewer's verdict gives way to
    a later one.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("timestamp"), F.desc(tie_break))
    return (
        log.where(F.col("text_assessment").isNotNull())
        .withColumn("row_number", F.row_number().over(newest_first))
        .where(F.col("row_number") == 1)
        .drop("row_number", "retrieval_assessment", "step_id", tie_break)
    )


def collect_retrieval(log: DataFrame) -> DataFrame:
    """Distinct retrieval assessments per (request, user, step), each with its count.

    ``(request_id, user_id, step_id, assessment, n, timestamp, source)``. They are rows at
    every size: equal assessments are counted on the map side, so a hot group shrinks
    to its distinct entries. ``retrieval_steps`` folds them.
    """
    return (
        log.where(F.col("retrieval_assessment").isNotNull())
        .groupBy(
            "request_id",
            F.col("source.id").alias("user_id"),
            "step_id",
            F.col("retrieval_assessment").alias("assessment"),
        )
        .agg(
            F.count("*").alias("n"),
            F.max("timestamp").alias("timestamp"),
            F.min("source").alias("source"),
        )
    )


def retrieval_steps(collected: DataFrame) -> DataFrame:
    """A row per (request, user, step): all its assessments, sorted, and their numbers.

    An entry of the list is a distinct assessment and its count, so the list of a hot step
    grows with the passages judged in it and not with the judgements.
    """
    return collected.groupBy("request_id", "user_id", "step_id").agg(
        F.sum("n").alias("n_assessments"),
        F.count("*").alias("n_distinct"),
        F.max("timestamp").alias("timestamp"),
        F.min("source").alias("source"),
        F.sort_array(F.collect_list(F.struct("assessment", "n"))).alias("retrieval_assessments"),
    )


def merge_assessments(
    latest: DataFrame, collected: DataFrame, keep_retrieval_only: bool = False
) -> DataFrame:
    """Full join of text feedback and steps of retrieval feedback on request and user.

    A user's retrieval-only feedback keeps its row but has no request id, unless
    ``keep_retrieval_only`` fills it in. Several steps give several rows, each with all
    assessments of its step.
    """
    columns = latest.columns
    one = latest.withColumn("_request", F.col("request_id")).withColumn(
        "_user", F.col("source.id")
    )
    many = retrieval_steps(collected).select(
        F.col("request_id").alias("_request"),
        F.col("user_id").alias("_user"),
        F.col("request_id").alias("request_id2"),
        F.col("source").alias("source2"),
        "step_id",
        "n_assessments",
        "n_distinct",
        "retrieval_assessments",
    )
    merged = full_join_many(one, many, ["_request", "_user"])
    if keep_retrieval_only:
        merged = merged.withColumn(
            "request_id", F.coalesce("request_id", "request_id2")
        ).withColumn("source", F.coalesce("source", "source2"))
    return merged.select(*columns, "step_id", "n_assessments", "n_distinct", "retrieval_assessments")


def requests_with_feedback(requests: DataFrame, merged: DataFrame, key: str = "log_id") -> DataFrame:
    """Every request with its feedback, if any."""
    one = requests.withColumn("_id", F.col(key))
    many = merged.withColumn("_id", F.col("request_id"))
    return left_join_many(one, many, ["_id"]).drop("_id")


def verdict(assessment: Column) -> Column:
    """The deciding rating's value; NULL where it is missing."""
    return assessment["ratings"][RATING]["value"]


def _judged(requests: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Rated feedback rows with request and response."""
    rated = merged.where(verdict(F.col("text_assessment")).isNotNull()).select(
        "request_id",
        F.col("source.id").alias("user_id"),
        verdict(F.col("text_assessment")).alias("verdict"),
        F.nullif(F.col("text_assessment.suggested_output"), F.lit("")).alias("edited"),
    )
    label = (
        F.when(F.col("verdict") == POSITIVE, THUMBS_UP)
        .when(F.col("verdict") == NEGATIVE, THUMBS_DOWN)
        .otherwise(NO_FEEDBACK)
    )
    asked = requests.withColumnRenamed(key, "request_id")
    return rated.join(asked, "request_id").withColumn("type", label)


def eval_set(requests: DataFrame, merged: DataFrame, key: str = "log_id") -> DataFrame:
    """The evaluation set as the reference SQL builds it.

    Its three branches exclude each other, so one scan labels every row. A
    thumbs-up always expects the logged response, even if it was edited.
    """
    expected = F.when(F.col("type") == THUMBS_UP, F.col("response")).otherwise(F.col("edited"))
    return _judged(requests, merged, key).select(
        "request_id", "request", expected.alias("expected_response"), "type", "user_id"
    )


def eval_set_documented(
    requests: DataFrame, merged: DataFrame, log: DataFrame, key: str = "log_id"
) -> DataFrame:
    """The evaluation set as the documentation describes it.

    An edit wins over the logged response, and requests that nobody assessed are
    part of the set, without an expected response.
    """
    response = F.when(F.col("type") == THUMBS_UP, F.col("response"))
    columns = ["request_id", "request", "expected_response", "type", "user_id"]
    judged = (
        _judged(requests, merged, key)
        .withColumn("expected_response", F.coalesce("edited", response))
        .select(*columns)
    )
    text = F.lit(None).cast("string")
    silent = (
        requests.withColumnRenamed(key, "request_id")
        .join(log.select("request_id").distinct(), "request_id", "left_anti")
        .withColumn("expected_response", text)
        .withColumn("type", F.lit(NO_FEEDBACK))
        .withColumn("user_id", text)
        .select(*columns)
    )
    return judged.unionByName(silent)


def expected_context(log: DataFrame) -> DataFrame:
    """``(request_id, doc_uri)`` of the passages that someone found helpful."""
    return (
        log.where(F.col("retrieval_assessment.value") == POSITIVE)
        .select("request_id", F.col("retrieval_assessment.doc_uri").alias("doc_uri"))
        .distinct()
    )
