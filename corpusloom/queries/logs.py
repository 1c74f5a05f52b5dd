"""Request and assessment logs derived from the given tables.

One request per conversation. Every event is an assessment of the request that
bears its user's number, so the logs grow with the tables. The event type says
which kind and verdict, the number in ``props`` the passage source and step, the
hour the reviewer; an event of high value brings an edited answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.files import table

TEXT_VERDICTS = {"purchase": "positive", "error": "negative", "view": "unsure"}
PASSAGE_VERDICTS = {"click": "positive", "signup": "negative"}
EDITED_ABOVE = 60


def _verdict(verdicts: dict[str, str]):
    event = F.col("event_type")
    pairs = list(verdicts.items())
    found = F.when(event == pairs[0][0], pairs[0][1])
    for name, value in pairs[1:]:
        found = found.when(event == name, value)
    return found


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")

    def last(role: str):
        return F.max_by("text", F.when(F.col("role") == role, F.col("turn")))

    return (
        turns.groupBy("conv_id")
        .agg(last("user").alias("request"), last("assistant").alias("response"))
        .select(F.concat(F.lit("r"), F.col("conv_id")).alias("log_id"), "request", "response")
    )


def assessment_log(spark: SparkSession, folder: str) -> DataFrame:
    judged = [*TEXT_VERDICTS, *PASSAGE_VERDICTS]
    events = table(spark, folder, "events").where(F.col("event_type").isin(judged))
    number = F.regexp_extract("props", "[0-9]+", 0)
    text_verdict, passage_verdict = _verdict(TEXT_VERDICTS), _verdict(PASSAGE_VERDICTS)
    edited = F.when(
        F.col("value") > EDITED_ABOVE, F.concat(F.lit("edit"), F.col("event_id"))
    ).otherwise("")
    rating = F.create_map(F.lit("answer_correct"), F.struct(text_verdict.alias("value")))
    return events.select(
        "event_id",
        F.concat(F.lit("r"), F.col("user_id")).alias("request_id"),
        F.struct(
            F.concat(F.lit("u"), F.floor(F.hour("ts") / 8).cast("string")).alias("id")
        ).alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(
            passage_verdict.isNotNull(),
            F.concat(F.lit("s"), F.floor(number.cast("int") / 25).cast("string")),
        ).alias("step_id"),
        F.when(
            text_verdict.isNotNull(),
            F.struct(rating.alias("ratings"), edited.alias("suggested_output")),
        ).alias("text_assessment"),
        F.when(
            passage_verdict.isNotNull(),
            F.struct(
                F.concat(F.lit("src"), F.substring(number, -1, 1)).alias("doc_uri"),
                passage_verdict.alias("value"),
            ),
        ).alias("retrieval_assessment"),
        F.lit("1").alias("schema_version"),
    )
