import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.vectors import HashEmbedder, unit
from corpusloom.operators.embedding import embed
from corpusloom.operators.index import (
    apply_changes,
    build_index,
    check_vectors,
    index_diff,
    knn_probed,
    knn_pruned,
    sync_index,
)
from corpusloom.operators.search import (
    BROADCAST_BYTES,
    best_k,
    candidates,
    each_once,
    knn,
    knn_within,
    matrix,
)

DIM = 8


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v.tolist(), g) for i, v, g in rows], "id long, embedding array<float>, grp string"
    )


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    hot = rng.normal(size=DIM)
    rows = []
    for i in range(600):
        # A third of all rows are copies of one vector, some are zero.
        v = hot if i < 200 else np.zeros(DIM) if i < 210 else rng.normal(size=DIM)
        rows.append((i, v.astype("float32"), "hot" if i % 3 else f"g{i % 5}"))
    return rows


@pytest.fixture(scope="module")
def corpus(spark, data):
    return vectors(spark, data).repartition(5).cache()


@pytest.fixture(scope="module")
def queries(corpus):
    return corpus.withColumnRenamed("id", "query_id")


def brute(data, k, allowed=lambda q, c: True):
    return brute_for(data, data, k, allowed)


def brute_for(queries, data, k, allowed=lambda q, c: True):
    out = []
    for qi, q, qg in queries:
        scored = []
        for ci, c, cg in data:
            if allowed(qg, cg):
                q64, c64 = q.astype("float64"), c.astype("float64")
                size = np.linalg.norm(q64) * np.linalg.norm(c64)
                scored.append((-round(q64 @ c64 / size, 6) if size else 0.0, ci))
        out += [(qi, r + 1, ci, -s + 0.0) for r, (s, ci) in enumerate(sorted(scored)[:k])]
    return out


def rows(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_knn_equals_brute_force(data, corpus, queries, limit):
    assert rows(knn(queries, corpus, 3, broadcast_bytes=limit)) == brute(data, 3)


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_knn_within_groups(data, corpus, queries, limit):
    want = brute(data, 4, lambda q, c: q == c)
    assert rows(knn_within(queries, corpus, "grp", 4, broadcast_bytes=limit)) == want


def test_small_blocks_split_a_hot_cell(data, corpus, queries):
    cell = F.lit(0).cast("long").alias("cell")
    asked = queries.select("query_id", F.col("embedding").alias("vector"), cell)
    stored = corpus.select("id", F.col("embedding").alias("vector"), cell)
    found = candidates(asked, stored, 3, broadcast_bytes=0, block_bytes=DIM * 8 * 50)
    assert rows(best_k(found, 3)) == brute(data, 3)


def test_filter_applies_before_scoring(data, corpus, queries):
    got = rows(knn(queries, corpus, 3, where=F.col("id") >= 590))
    assert {r[2] for r in got} <= set(range(590, 600)) and len(got) == 1800


def test_copies_of_queries_are_searched_once(spark, data, corpus, index):
    most = [(i, data[i % 40 + 190][1], data[i % 40 + 190][2]) for i in range(300)]
    queries = vectors(spark, most).withColumnRenamed("id", "query_id")
    searched = []

    def run(asked):
        searched.append(asked.count())
        return knn_probed(asked.withColumnRenamed("vector", "embedding"), index, 3, 99)

    exact = {r[0]: r[1:] for r in rows(each_once(queries.select("query_id", F.col("embedding").alias("vector")), run))}
    # Twelve copies of the hot vector, ten zero vectors, the rest distinct.
    assert searched == [len({v.tobytes() for _, v, _ in most})] and len(exact) == 300
    want = rows(knn_pruned(queries, index, 3))
    assert rows(knn(queries, corpus, 3)) == want and len(want) == 900
    flat = brute_for(most, data, 3)
    assert want == flat
    within = rows(knn_within(queries, corpus, "grp", 2))
    assert within == brute_for(most, data, 2, lambda q, c: q == c)


def test_fewer_candidates_than_k(corpus, queries):
    got = rows(knn(queries, corpus, 3, where=F.col("id") == 5))
    assert [r[1] for r in got] == [1] * 600


def test_no_candidate_and_no_query(corpus, queries):
    assert rows(knn(queries, corpus, 3, where=F.col("id") < 0)) == []
    assert rows(knn(queries.where("query_id < 0"), corpus, 3)) == []


@pytest.fixture(scope="module")
def index(corpus):
    return build_index(corpus, DIM, cells=6)


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_pruned_search_is_exact(data, index, queries, limit):
    assert rows(knn_pruned(queries, index, 3, broadcast_bytes=limit)) == brute(data, 3)


def test_probing_all_cells_is_exact(data, index, queries):
    assert rows(knn_probed(queries, index, 3, nprobe=99)) == brute(data, 3)


def test_recall_grows_with_probes(data, index, queries):
    exact = {(q, i) for q, _, i, _ in brute(data, 3)}
    recall = [
        len({(q, i) for q, _, i, _ in rows(knn_probed(queries, index, 3, n))} & exact) / len(exact)
        for n in (1, 3, 6)
    ]
    assert recall == sorted(recall) and recall[0] > 0.4 and recall[-1] == 1.0


def test_index_rejects_repeated_ids_and_other_dimensions(spark, corpus):
    with pytest.raises(ValueError, match="unique"):
        check_vectors(corpus.union(corpus).withColumnRenamed("embedding", "vector"), DIM)
    with pytest.raises(ValueError, match="dimension"):
        check_vectors(corpus.withColumnRenamed("embedding", "vector"), DIM + 1)


def test_sync_equals_rebuilt_search_and_repeats(spark, data, corpus, index, queries):
    changed = [(i, v if i % 2 else -v, g) for i, v, g in data if i >= 30]
    changed += [(1000 + i, np.ones(DIM, "float32") * i, "new") for i in range(1, 4)]
    new = vectors(spark, changed)
    diff = index_diff(corpus, new, "id", "embedding")
    assert diff.where("change = 'delete'").count() == 30
    assert diff.where("change = 'insert'").count() == 3
    synced = sync_index(index, diff)
    want = rows(knn(queries, new, 3))
    assert rows(knn_pruned(queries, synced, 3)) == want
    assert rows(knn_pruned(queries, sync_index(synced, diff), 3)) == want
    table = apply_changes(corpus.select("id", "embedding"), diff, "id")
    assert index_diff(table, new, "id", "embedding").isEmpty()


def test_diff_sees_a_value_that_moves_to_another_column(spark):
    old = spark.createDataFrame([(1, None, "x"), (2, "a", None)], "id long, p string, q string")
    new = spark.createDataFrame([(1, "x", None), (2, "a", None)], "id long, p string, q string")
    assert [tuple(r) for r in index_diff(old, new, "id", "p", "q").collect()] == [(1, "update", "x", None)]


def test_vectors_of_different_length_are_refused():
    with pytest.raises(ValueError, match="dimension"):
        matrix(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]))


def test_hash_embedder_words_and_zero(spark):
    texts = ["Apple apple pie", "", "äöü !"]
    got = HashEmbedder(16)(texts)
    assert np.allclose(np.linalg.norm(got, axis=1), [1, 0, 0])
    assert np.array_equal(got[:1], HashEmbedder(16)(["pie APPLE, apple"]))


def test_embed_batches_and_checks(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(400)], "i long, text string").coalesce(1)
    sizes = embed(df, "text", lambda texts: np.full((len(texts), 2), len(texts)), 2)
    assert {r.embedding[0] for r in sizes.collect()} == {150.0, 100.0}
    with pytest.raises(Exception, match="embedder gave"):
        embed(df, "text", lambda texts: np.zeros((len(texts) - 1, 2)), 2).collect()
    with pytest.raises(Exception, match="embedder gave"):
        embed(df, "text", lambda texts: np.zeros((len(texts), 3)), 2).collect()


def test_unit_vector(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(unit(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_many_results_a_query_are_bounded_like_vectors(data, corpus, queries, monkeypatch):
    """The results that a task holds count as its vectors do."""
    from corpusloom.operators import search

    def scanned(*_):
        raise AssertionError("all results in one task")

    monkeypatch.setattr(search, "_scan", scanned)
    cell = F.lit(0).cast("long").alias("cell")
    asked = queries.select("query_id", F.col("embedding").alias("vector"), cell)
    stored = corpus.select("id", F.col("embedding").alias("vector"), cell)
    found = candidates(asked, stored, 300, broadcast_bytes=600 * DIM * 8, block_bytes=300 * 16 * 200)
    assert rows(best_k(found, 300)) == brute(data, 300)


def test_screened_scores_equal_ranked_ones():
    from corpusloom.operators.search import SCALE, Best

    rng = np.random.default_rng(3)
    away = rng.normal(size=(4000, 16))
    away[::3] = away[5]
    away[::7] = 0
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-30)
    asked, ids = away[:200], rng.permutation(10**6)[:4000]
    best = Best(200, 3)
    for at in range(0, 4000, 1000):
        best.add(np.arange(200), asked, ids[at : at + 1000], away[at : at + 1000])
    points = np.rint(asked @ away.T * SCALE).astype("int64")
    for i in range(200):
        order = np.lexsort((ids, -points[i]))[:3]
        assert best.ids[i].tolist() == ids[order].tolist()
        assert best.points[i].tolist() == points[i][order].tolist()


def test_embedding_holds_the_texts_of_one_call(spark):
    """All texts of an Arrow batch were Python strings, held beside those of the call."""
    import sys

    def embedder(texts):
        # The list of the call, and the argument here.
        if max(sys.getrefcount(t) for t in texts if t) > 3:
            raise ValueError("texts are held by more than the call")
        return np.array([[len(t or ""), 0, 0, 1] for t in texts])

    words = F.concat(F.lit("words "), F.lpad(F.col("id").cast("string"), 4, "0"))
    texts = spark.range(3000).select("id", F.when(F.col("id") != 7, words).alias("t")).coalesce(1)
    rows = embed(texts, "t", embedder, 4, batch=100).groupBy("embedding").count().collect()
    assert sorted((r.embedding[0], r["count"]) for r in rows) == [(0.0, 1), (10.0, 2999)]
