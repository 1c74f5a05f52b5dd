"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors is joined to its nearest neighbours, that graph is cut into
parts of equal size with as few edges between parts as moves of single vertices can
reach, and a small network learns, from a vector alone, how its neighbours spread over
the parts. Every row is then indexed by its most probable part. A query goes to the
parts that are most probable for it; how many is found on the sample, by the share of
true neighbours that they hold. What it meets there is ranked by exact distances. A query
that meets fewer rows than it wants goes on to all other parts.

There are parts at every size: as many as rows over ``rows_per_part``, at least
``LEAST_PARTS`` and at most ``MOST_PARTS``, with at least 64 distinct sampled vectors each. A table
of fewer than 128 distinct vectors is one part.

Parts are searched in blocks of bounded size on both sides, so a part or a vector with
a third of all rows only has more blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.samples import about
from corpusloom.session import stage

SAMPLE = 12_000
ROWS_PER_PART = 2_000
LEAST_PARTS, MOST_PARTS = 8, 128
NEIGHBOURS = 10
RECALL = 0.96
HIDDEN = 128
ROWS_PER_BLOCK = 10_000
QUERIES_PER_BLOCK = 2_000
SEED = 23


def usable(column: str) -> Column:
    """Whether a vector takes part: it has components, all finite, and one besides zero."""
    value = F.col(column)
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def nearest(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query number, row numbers and distances of the k nearest rows of another id.

    Matrix products find all rows that can be among them, differences rank those; equal
    distances rank by id.
    """
    lengths = (rows * rows).sum(axis=1)
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        squares = (some * some).sum(axis=1)[:, None] + lengths[None, :] - 2 * some @ rows.T
        slack = 1e-9 * ((some * some).sum(axis=1) + lengths.max(initial=0.0))
        for i, near in enumerate(squares):
            q = at + i
            near = np.where(ids == query_ids[q], np.inf, near)
            level = np.partition(near, k - 1)[k - 1] if len(near) > k else np.inf
            held = np.flatnonzero((near <= level + slack[i]) & np.isfinite(near))
            off = rows[held] - queries[q]
            distance = np.sqrt((off * off).sum(axis=1))
            order = np.lexsort((ids[held], distance))[:k]
            yield q, held[order], distance[order]


def neighbour_graph(rows: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest other rows of every row."""
    own = np.arange(len(rows))
    graph = np.zeros((len(rows), min(k, len(rows) - 1)), "int64")
    for q, near, _ in nearest(rows, own, rows, own, graph.shape[1]):
        graph[q] = near
    return graph


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, passes: int = 12) -> np.ndarray:
    """A part for every vertex, all of near equal size, with few edges between parts.

    Halving along the widest direction begins; then vertices move to the part of most of
    their neighbours, those that gain most first, where the part has room.
    """
    part = np.zeros(len(rows), "int64")
    todo = [(np.arange(len(rows)), 0, parts)]
    while todo:
        own, first, n = todo.pop()
        if n == 1:
            part[own] = first
            continue
        centred = rows[own] - rows[own].mean(axis=0)
        along = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = own[np.argsort(centred @ along, kind="stable")]
        cut = len(own) * (n // 2) // n
        todo += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    room = math.ceil(1.05 * len(rows) / parts)
    edges = np.concatenate(
        [
            np.stack([np.repeat(np.arange(len(rows)), graph.shape[1]), graph.ravel()], axis=1),
            np.stack([graph.ravel(), np.repeat(np.arange(len(rows)), graph.shape[1])], axis=1),
        ]
    )
    size = np.bincount(part, minlength=parts)
    for _ in range(passes):
        pull = np.zeros((len(rows), parts))
        np.add.at(pull, (edges[:, 0], part[edges[:, 1]]), 1)
        gain = pull.max(axis=1) - pull[np.arange(len(rows)), part]
        moved = 0
        for vertex in np.argsort(-gain, kind="stable"):
            if gain[vertex] <= 0:
                break
            to = int(pull[vertex].argmax())
            if size[to] < room:
                size[part[vertex]] -= 1
                size[to] += 1
                part[vertex] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network with one hidden layer from vectors to parts, and how many parts to ask."""

    weights: list[np.ndarray]
    probes: int
    parts: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.zeros((len(rows), 1))
        one, two, three, four, scale = self.weights
        return np.maximum((rows * scale) @ one + two, 0) @ three + four


def train_router(rows: np.ndarray, target: np.ndarray, passes: int = 30, seed: int = SEED) -> list:
    """Weights that give the shares of the parts among a vector's neighbours."""
    rng = np.random.default_rng(seed)
    scale = np.array(1 / max(1e-12, rows.std()))
    x, parts = rows * scale, target.shape[1]
    w = [
        rng.normal(0, math.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    one, two, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for p in range(passes):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            b = order[at : at + 256]
            hidden = np.maximum(x[b] @ w[0] + w[1], 0)
            score = hidden @ w[2] + w[3]
            likely = np.exp(score - score.max(axis=1, keepdims=True))
            off = (likely / likely.sum(axis=1, keepdims=True) - target[b]) / len(b)
            back = (off @ w[2].T) * (hidden > 0)
            slopes = [x[b].T @ back, back.sum(axis=0), hidden.T @ off, off.sum(axis=0)]
            t += 1
            for i, g in enumerate(slopes):
                one[i] = 0.9 * one[i] + 0.1 * g
                two[i] = 0.999 * two[i] + 0.001 * g * g
                step = (one[i] / (1 - 0.9**t)) / (np.sqrt(two[i] / (1 - 0.999**t)) + 1e-8)
                w[i] = w[i] - 0.003 * (1 - 0.9 * p / passes) * step
    return [*w, scale]


def learn(rows: np.ndarray, parts: int, k: int = NEIGHBOURS, recall: float = RECALL, seed: int = SEED) -> Router:
    """Partition a sample, train the router, and choose the number of parts to ask.

    Four fifths train; the rest are queries against the sample. All parts are asked if
    fewer do not reach the recall.
    """
    rows = np.unique(rows, axis=0)
    parts = max(1, min(parts, len(rows) // 64))
    if parts == 1:
        return Router([], 1, 1)
    graph = neighbour_graph(rows, k)
    part = balanced_parts(rows, graph, parts)
    target = np.zeros((len(rows), parts))
    np.add.at(target, (np.repeat(np.arange(len(rows)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(rows)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    held = np.random.default_rng(seed).random(len(rows)) < 0.2
    router = Router(train_router(rows[~held], target[~held]), parts, parts)
    scores = router.scores(rows)
    home, order = scores.argmax(axis=1), np.argsort(-scores[held], axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    asked = np.take_along_axis(place, home[graph[held]], axis=1)
    for probes in range(1, parts + 1):
        if (asked < probes).mean() >= recall:
            router.probes = probes
            break
    return router


def nearest_rows(
    table: DataFrame,
    queries: DataFrame,
    k: int = 10,
    sample: int = SAMPLE,
    rows_per_part: int = ROWS_PER_PART,
    most_parts: int = MOST_PARTS,
    recall: float = RECALL,
    seed: int = SEED,
) -> DataFrame:
    """The k nearest rows found, as ``(query_id, rank, vec_id, score)``.

    Both tables are ``(vec_id, embedding)``; a row of the query's own id is no candidate.
    ``score`` is the Euclidean distance in double precision; equal ones rank by vec_id.
    ``sample`` bounds the vectors that the index is fitted on. Rows with a null vec_id,
    vectors that are null or zero, hold null or non-finite components or are of another
    length than most take no part; a query id that repeats asks with its smallest vector;
    repeated rows are candidates each; other columns are not read; without candidates
    there are no rows.
    """
    own = table.where(F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", "embedding")
    counted = own.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows"))
    common = counted.orderBy(F.desc("rows"), "n").first()
    dim, rows = (common["n"], common["rows"]) if common else (0, 0)
    own = own.where(F.size("embedding") == dim)
    drawn = about(own.select("vec_id", "embedding"), "vec_id", sample, seed).toArrow() if rows else None
    vectors = matrix(drawn.sort_by("vec_id")["embedding"]) if rows else np.zeros((0, 1))
    parts = max(LEAST_PARTS, min(most_parts, rows // rows_per_part))
    router = learn(vectors, parts, recall=recall, seed=seed)

    @F.arrow_udf("array<int>")
    def likely(column: pa.Array) -> pa.Array:
        """All parts, the most probable first."""
        scores = router.scores(matrix(column))
        order = np.argsort(-scores, axis=1, kind="stable").astype("int32")
        return pa.FixedSizeListArray.from_arrays(pa.array(order.ravel()), order.shape[1]).cast(
            pa.list_(pa.int32())
        )

    index = own.withColumn("part", likely("embedding")[0])
    index = stage(index, "learned-index")
    asked = (
        queries.where(F.col("vec_id").isNotNull() & usable("embedding") & (F.size("embedding") == dim))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .select(F.col("vec_id").alias("query_id"), "embedding", likely("embedding").alias("order"))
    )
    asked = stage(asked, "routed-queries")
    first = F.explode(F.slice("order", 1, router.probes)).alias("part")
    found = _searched(index, asked.select("query_id", "embedding", first), k)
    if router.probes < router.parts:
        found = stage(found, "found")
        met = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
        short = stage(asked.join(met, "query_id", "left_anti"), "short")
        if not short.isEmpty():
            others = F.explode(F.slice("order", router.probes + 1, router.parts)).alias("part")
            found = found.unionByName(_searched(index, short.select("query_id", "embedding", others), k))
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _searched(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of every query in every block of the parts it asks."""

    def blocks(frame: DataFrame, size: int, name: str) -> DataFrame:
        return frame.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    # One row per part.
    sizes = blocks(index, ROWS_PER_BLOCK, "row_blocks").join(
        blocks(asked, QUERIES_PER_BLOCK, "query_blocks"), "part"
    )

    def dealt(frame: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return (
            frame.join(F.broadcast(sizes), "part")
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .drop("row_blocks", "query_blocks")
        )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            query_ids, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
            for q, near, distance in nearest(
                matrix(left["embedding"]), query_ids, matrix(right["embedding"]), ids, k
            ):
                found["query_id"].append(np.full(len(near), query_ids[q]))
                found["vec_id"].append(ids[near])
                found["score"].append(distance)
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table(
            {c: pa.array(np.concatenate([np.zeros(0), *v]), kinds[c]) if c == "score"
             else pa.array(np.concatenate([np.zeros(0, "int64"), *v]), kinds[c]) for c, v in found.items()}
        )

    group = ["part", "row_block", "query_block"]
    return (
        dealt(asked, "query_id", "query_block", "row_block")
        .groupBy(*group)
        .cogroup(dealt(index, "vec_id", "row_block", "query_block").groupBy(*group))
        .applyInArrow(rank, "query_id long, vec_id long, score double")
    )
