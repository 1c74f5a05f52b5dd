"""The named index: reopened, searched, changed and merged, against exact search."""

import json
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.index import index_diff, knn_pruned
from corpusloom.operators.named_index import create_index, open_index
from corpusloom.operators.search import knn

DIM = 8


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v.tolist(), g, f"text {i}") for i, v, g in rows], "id long, embedding array<float>, grp string, content string"
    )


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    centers, hot = rng.normal(size=(12, DIM)), rng.normal(size=DIM)
    rows = []
    for i in range(1500):
        # A third of all rows are copies of one vector, some are zero.
        v = hot if i < 500 else np.zeros(DIM) if i < 510 else centers[i % 12] + rng.normal(size=DIM) / 3
        rows.append((i, v.astype("float32"), f"g{i % 4}"))
    return rows


@pytest.fixture(scope="module")
def corpus(spark, data):
    return frame(spark, data).repartition(6).cache()


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("indexes"))


@pytest.fixture(scope="module")
def index(corpus, root):
    return create_index(root, "chunks", corpus, DIM, ["grp"], ["content"], rows_per_cell=40)


@pytest.fixture(scope="module")
def queries(corpus):
    return corpus.where("id % 5 = 0").select(F.col("id").alias("query_id"), "embedding").cache()


def rows(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


def files(root, *folders):
    return {
        str(p): p.stat().st_mtime_ns
        for p in Path(root).rglob("*.parquet")
        if not folders or any(f in str(p) for f in folders)
    }


def test_all_rows_have_the_cell_most_like_them(index, data):
    cells = {r.cell: np.array(r.centroid) for r in index.cells().collect()}
    found = index.rows().collect()
    assert sorted(r.id for r in found) == [i for i, _, _ in data] and len(cells) > 20
    for r in found[::7]:
        v = np.array(r.vector, dtype=float)
        own = {c: x @ v for c, x in cells.items() if c // 65536 == r.coarse}
        assert own[r.cell] >= max(own.values()) - 1e-9


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_all_cells_give_exact_results(index, corpus, queries, limit):
    found = index.search(queries, 3, nprobe=10_000, broadcast_bytes=limit)
    assert rows(found) == rows(knn(queries, corpus, 3))


def test_recall_of_the_default(index, corpus, queries):
    exact = {r[:1] + r[2:3]: r[3] for r in rows(knn(queries, corpus, 3))}
    found = rows(index.search(queries, 3))
    # Copies tie, so a hit counts by its score.
    least = {q: min(s for (p, _), s in exact.items() if p == q) for q, _ in exact}
    hits = sum(s >= least[q] for q, _, _, s in found)
    assert len(found) == len(exact) and hits / len(exact) >= 0.9


def test_a_filter_is_pushed_down_and_widens_the_search(index, corpus, queries):
    rare = (F.col("grp") == "g1") & (F.col("id") % 300 == 1)
    found = rows(index.search(queries, 3, nprobe=2, where=rare))
    assert {r[2] for r in found} <= {1, 301, 601, 901, 1201} and len(found) == 3 * queries.count()
    plan = index.rows().where("grp = 'g1'")._jdf.queryExecution().toString()
    assert "EqualTo(grp,g1)" in plan


def test_probed_cells_prune_partitions(index, queries):
    probes = index._probes(queries.select("query_id", F.col("embedding").alias("vector")), 2)
    plan = index._within(probes, None)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan


def test_payload_comes_by_ranges(index, queries, monkeypatch):
    found = index.with_payload(index.search(queries.where("query_id < 600"), 2))
    assert all(r.content == f"text {r.id}" for r in found.collect())
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and found.columns == ["query_id", "rank", "id", "score", "content"]


def test_opened_in_another_session(index, root, queries):
    code = (
        "import sys, json; sys.path.insert(0, sys.argv[2])\n"
        "from corpusloom.session import local_session\n"
        "from corpusloom.operators.named_index import open_index\n"
        "spark = local_session('2', 2)\n"
        "index = open_index(spark, sys.argv[1], 'chunks')\n"
        "q = index.table().where('id % 100 = 50').selectExpr('id as query_id', 'embedding')\n"
        "print(json.dumps([list(r) for r in index.search(q, 2, 10000).orderBy('query_id', 'rank').collect()]))\n"
    )
    out = subprocess.run(
        [sys.executable, "-c", code, root, str(Path(__file__).parent.parent)],
        capture_output=True, text=True, check=True, env=os.environ,
    ).stdout
    want = rows(index.search(queries.where("query_id % 100 = 50"), 2, 10_000))
    assert [tuple(r) for r in json.loads(out.strip().splitlines()[-1])] == want


def test_pruned_search_takes_radii_from_the_manifest(index, corpus, queries):
    cells = index.vector_index()
    assert cells.known_radii is not None
    assert rows(knn_pruned(queries, cells, 3)) == rows(knn(queries, corpus, 3))


def test_sync_and_merge(spark, data, corpus, root, queries):
    index = create_index(root, "changing", corpus, DIM, ["grp"], ["content"], rows_per_cell=40)
    old_files = files(f"{root}/changing/rows")
    # Changes near one vector only, so that few coarse cells are touched.
    near = [i for i, v, _ in data if i >= 510 and i % 12 == 3]
    changed = [(i, v * 2, "new") if i in near[:20] else (i, v, g) for i, v, g in data if i not in near[20:40]]
    changed += [(5000 + i, data[near[0]][1] + np.float32(i / 100), "new") for i in range(5)]
    new = frame(spark, changed)
    columns = ["embedding", "grp", "content"]
    diff = index_diff(corpus, new, "id", *columns)
    synced = index.sync(diff)
    assert sorted(map(tuple, synced.table().collect())) == sorted(map(tuple, new.collect()))
    want = rows(knn(queries, new, 3))
    assert rows(synced.search(queries, 3, 10_000)) == want
    assert rows(knn_pruned(queries, synced.vector_index(), 3)) == want
    # Nobody's files changed; the generation that was open still reads its own table.
    assert files(f"{root}/changing/rows").items() >= old_files.items()
    assert sorted(r.id for r in index.rows().collect()) == [i for i, _, _ in data]
    # Applied once more, and found by another reader.
    again = open_index(spark, root, "changing").sync(diff)
    assert sorted(map(tuple, again.table().collect())) == sorted(map(tuple, new.collect()))

    before = {(r["segment"], r["coarse"]) for r in again.live if r["kind"] == "rows"}
    worn = {c for s, c in before if s > 1} | {r["coarse"] for r in again.live if r["kind"] == "dead"}
    merged = again.merge()
    after = {(r["segment"], r["coarse"]) for r in merged.live if r["kind"] == "rows"}
    # Untouched cells keep their files, touched ones have one segment and no dead rows.
    assert {p for p in before if p[1] not in worn} == {p for p in after if p[1] not in worn}
    assert 0 < len(worn) < len({c for _, c in before}) and {s for s, c in after if c in worn} == {max(s for s, _ in after)}
    assert not [r for r in merged.live if r["kind"] == "dead"]
    assert sorted(map(tuple, merged.table().collect())) == sorted(map(tuple, new.collect()))
    assert rows(merged.search(queries, 3, 10_000)) == want
    assert merged.merge().generation == merged.generation


def test_marks_make_a_replayed_sync_a_no_op(spark, corpus, root):
    index = create_index(root, "marked", corpus, DIM, ["grp"], ["content"], rows_per_cell=100)
    gone = corpus.where("id < 3").withColumn("change", F.lit("delete"))
    first = index.sync(gone, mark="batch-1")
    assert first.sync(gone, mark="batch-1").generation == first.generation
    assert open_index(spark, root, "marked").table().count() == corpus.count() - 3


def test_two_writers_and_wrong_input(spark, corpus, root):
    index = create_index(root, "raced", corpus, DIM, rows_per_cell=500)
    index.sync(corpus.where("id = 1").withColumn("change", F.lit("delete")))
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        index.sync(corpus.where("id = 2").withColumn("change", F.lit("delete")))
    with pytest.raises(ValueError, match="several"):
        open_index(spark, root, "raced").sync(corpus.where("id = 2").union(corpus.where("id = 2")).withColumn("change", F.lit("update")))
    with pytest.raises(FileNotFoundError):
        open_index(spark, root, "missing")
    with pytest.raises(ValueError, match="dimension"):
        create_index(root, "wrong", corpus, DIM + 1)


def test_empty_index(spark, corpus, root, queries):
    index = create_index(root, "empty", corpus.where("false"), DIM, ["grp"], ["content"])
    assert index.search(queries, 3).count() == 0 and index.table().count() == 0
    filled = index.sync(corpus.where("id < 700").withColumn("change", F.lit("insert")))
    assert filled.table().count() == 700
    assert rows(filled.search(queries, 3)) == rows(knn(queries, corpus.where("id < 700"), 3))


@pytest.mark.parametrize("where", [None, "grp = 'g1'"])
def test_all_cells_make_no_list_of_them(index, corpus, queries, monkeypatch, where):
    """A list of every query's cells, and as many results each, grew with queries times rows."""

    def listed(*_):
        raise AssertionError("cells were listed")

    monkeypatch.setattr(type(index), "_probes", listed)
    wanted = None if where is None else F.expr(where)
    got = index.search(queries, 3, nprobe=1 << 40, where=wanted)
    assert rows(got) == rows(knn(queries, corpus, 3, where=wanted))
