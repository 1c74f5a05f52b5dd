"""Columns computed by caller-supplied Python: file parsers and text generators."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from corpusloom.functions.prompts import DEFAULT_NEW_TOKENS, DEFAULT_TEMPERATURE
from corpusloom.functions.text import join_pages

Parser = Callable[[bytes], Sequence[str]]
Generator = Callable[[pd.DataFrame], Sequence[str]]
# Reads the pieces of one prompt and gives its answer.
StreamGenerator = Callable[[Iterator[str], dict], str]


def extract_text(
    df: DataFrame, make_parser: Callable[[], Parser], content_col: str = "content"
) -> DataFrame:
    """Replace file bytes by ``text`` (clean pages joined) and ``error``.

    ``make_parser`` runs once per task. A file that fails to parse keeps its row
    with NULL text and the error; ``parsed`` and ``quarantined`` tell them apart.
    The parser counts as nondeterministic, so that a filter on its result is not
    pushed below it, which would parse every file twice.
    """

    @F.pandas_udf("pages array<string>, error string")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = make_parser()

        def one(content: bytes | None) -> tuple[list[str] | None, str | None]:
            try:
                return [str(page) for page in parser(content)], None
            except Exception as problem:  # noqa: BLE001 - any parser, any error
                return None, f"{type(problem).__name__}: {problem}"

        for contents in batches:
            yield pd.DataFrame([one(c) for c in contents], columns=["pages", "error"])

    keep = [c for c in df.columns if c != content_col]
    once = parse.asNondeterministic()
    return df.select(*keep, once(F.col(content_col)).alias("parsed")).select(
        *keep, join_pages(F.col("parsed.pages")).alias("text"), F.col("parsed.error").alias("error")
    )


def parsed(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("error").isNull()).drop("error")


def quarantined(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("error").isNotNull()).drop("text")


def generate_streamed(
    pieces: DataFrame,
    key: str,
    order: str,
    make_generator: Callable[[], StreamGenerator],
    out: str = "output",
) -> DataFrame:
    """``(key, out)``: one model call per key over its ordered pieces ``(key, order, text)``.

    The generator gets an iterator of texts, which it may read as far as it likes, and the
    key's ``temperature`` and ``max_new_tokens``: its first piece's columns of these names, or the
    defaults. Pieces pass by in order, so a call may span many Arrow batches and a
    prompt never has to fit one value.
    """
    given = {"temperature": ("double", DEFAULT_TEMPERATURE), "max_new_tokens": ("long", DEFAULT_NEW_TOKENS)}
    settings = [
        F.coalesce((F.col(n) if n in pieces.columns else F.lit(None)).cast(kind), F.lit(fallback).cast(kind)).alias(n)
        for n, (kind, fallback) in given.items()
    ]
    streamed = (
        pieces.select(key, order, "text", *settings).repartition(key).sortWithinPartitions(key, order)
    )
    schema = pa.schema([pa.field(key, to_arrow_type(pieces.schema[key].dataType)), pa.field(out, pa.string())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = make_generator()
        rows = (row for batch in batches for row in zip(*(batch[n].to_pylist() for n in (key, "text", *given))))
        for name, group in itertools.groupby(rows, key=lambda row: row[0]):
            _, first, temperature, limit = next(group)
            texts = itertools.chain([first], (row[1] for row in group))
            request = {"temperature": temperature, "max_new_tokens": limit}
            reply = generator((t for t in texts if t is not None), request)
            yield pa.RecordBatch.from_arrays([pa.array([name], schema[0].type), pa.array([reply], pa.string())], schema=schema)

    return streamed.mapInArrow(answer, StructType([pieces.schema[key]]).add(out, "string"))


def generate(
    df: DataFrame,
    make_generator: Callable[[], Generator],
    prompt: Column,
    system_prompt: Column,
    temperature: Column | None = None,
    max_new_tokens: Column | None = None,
    out: str = "output",
) -> DataFrame:
    """Add generated text. Missing parameters take their defaults row by row, and a
    row without a prompt gets no text.

    The generator sees a frame with the columns prompt, system_prompt,
    temperature and max_new_tokens and replies with one text per row.
    """

    def default(value: Column | None, fallback: float, kind: str) -> Column:
        given = F.lit(None) if value is None else value
        return F.coalesce(given.cast(kind), F.lit(fallback).cast(kind))

    request = F.struct(
        prompt.alias("prompt"),
        system_prompt.alias("system_prompt"),
        default(temperature, DEFAULT_TEMPERATURE, "double").alias("temperature"),
        default(max_new_tokens, DEFAULT_NEW_TOKENS, "long").alias("max_new_tokens"),
    )

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        generator = make_generator()
        for batch in batches:
            requests = batch[batch["prompt"].notna()]
            replies = list(generator(requests)) if len(requests) else []
            if len(replies) != len(requests):
                raise ValueError(f"{len(replies)} replies for {len(requests)} requests")
            yield pd.Series(replies, index=requests.index, dtype=object).reindex(batch.index)

    # Sampled text differs from run to run, and a filter on it must not run the model twice.
    return df.withColumn(out, answer.asNondeterministic()(request))
