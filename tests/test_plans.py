"""Physical plans: what reaches the scan, what is pruned early, what never happens."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.chunking import chunk_sentences
from corpusloom.operators.embedding import embed
from corpusloom.queries.spark import QUERIES

WRITES_FIRST = {"ingest_files", "embed_stream", "corpus_to_index", "index_build", "knn_ivf", "knn_pruned"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_no_query_pairs_all_rows(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_latest_row_is_limited_before_the_shuffle(spark, sf):
    text = plan(QUERIES["dedup_latest"](spark, sf))
    assert re.search(r"row_number\(\), 1, Partial", text)


def test_top_k_is_limited_before_the_shuffle(spark, sf):
    assert re.search(r"row_number\(\), 3, Partial", plan(QUERIES["knn_exact"](spark, sf)))


def test_chunking_does_not_shuffle(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert "Exchange" not in plan(chunk_sentences(documents))


def test_log_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["expected_context"](spark, sf))
    assert re.search(r"PushedFilters: \[[^]]*event_type", text)
    assert "ts" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_filter_passes_below_the_embedder(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    df = embed(documents, "text", lambda t: [[0.0]] * len(t), 1).where(F.col("doc_id") == 7)
    text = plan(df)
    assert text.index("ArrowEvalPython") < text.index("Filter")
    assert "EqualTo(doc_id,7)" in text
