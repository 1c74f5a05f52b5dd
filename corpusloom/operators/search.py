"""Exact nearest-neighbour search for whole tables of queries.

The similarity is the cosine, 0 for a zero vector, rounded to six decimals;
equal scores rank by id. Both sides carry a ``cell`` and a query meets only the
vectors of its cell: one cell for plain search, the permitted group for
filtered search, the probed cells of an index for pruned search.

No plan here pairs rows in a join. A query side of checked size travels to the
tasks that scan the corpus, which keep k rows per query and move no vector.
Beyond that size both sides are cut into bounded blocks, so neither a large
query table nor a cell with a third of all rows ends up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

SCALE = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 64 * 1024 * 1024
TILE_SCORES = 4_000_000
# Scores per screened tile, which should fit a core's cache, and rows ranked before any is screened.
SCREEN_SCORES = 1 << 19
FIRST_ROWS = 64
FOUND_BYTES = 64
RESULT_BYTES = 16
FOUND = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("points", pa.int64())])
FOUND_DDL = "query_id long, id long, points long"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix of doubles, each of length one or zero."""
    rows = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if rows == 0:
        return flat.reshape(0, 0)
    if column.null_count or len(pc.list_value_length(column).unique()) > 1:
        raise ValueError("vectors of different dimension or missing")
    wide = flat.reshape(rows, -1)
    length = np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return np.divide(wide, length, out=np.zeros_like(wide), where=length > 0)


class Best:
    """The k best ids of every query seen so far.

    Rows are scored in growing runs. The first one is ranked in full; in later ones single
    precision tells which scores may still enter, and only those are computed in double.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.points = np.full((queries, k), np.iinfo("int64").min)
        self.ids = np.full((queries, k), np.iinfo("int64").max)

    def add(self, which: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        """Score the queries ``which`` against ``rows`` with their ``ids``."""
        if len(ids) == 0 or len(which) == 0:
            return
        if rows.shape[1] != vectors.shape[1]:
            raise ValueError(f"vectors of dimension {rows.shape[1]}, queries of {vectors.shape[1]}")
        at, step = 0, max(FIRST_ROWS, 4 * self.k)
        while at < len(ids):
            run = slice(at, at + step)
            self._add_run(which, vectors, ids[run], rows[run])
            at, step = at + step, min(2 * step, SCREEN_SCORES // FIRST_ROWS)

    def _add_run(self, which: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids)
        ids, rows = ids[order], rows[order]
        tile, coarse = max(1, SCREEN_SCORES // len(ids)), rows.T.astype("float32")
        for at in range(0, len(which), tile):
            mine = which[at : at + tile]
            worst = self.points[mine, -1]
            if (worst == np.iinfo("int64").min).any():
                self._rank(mine, vectors, ids, rows)
                continue
            asked = vectors[mine]
            # Vectors are of length one, so this bounds the error of a sum in single precision.
            error = (rows.shape[1] + 8) * 2.0**-23
            least = np.nextafter(((worst - 1) / SCALE - error).astype("float32"), np.float32(-2))
            hits = np.flatnonzero(asked.astype("float32") @ coarse >= least[:, None])
            if len(hits) > len(mine) * len(ids) // 16:
                self._rank(mine, vectors, ids, rows)
            elif len(hits):
                self._merge(mine, asked, ids, rows, hits)

    def _rank(self, which: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        """Every score in double precision."""
        n = len(ids)
        # One integer holds score and id order, so a partial sort needs no tie rule.
        by_id = np.arange(n - 1, -1, -1)
        tile = max(1, TILE_SCORES // n)
        for at in range(0, len(which), tile):
            mine = which[at : at + tile]
            points = np.rint(vectors[mine] @ rows.T * SCALE).astype("int64")
            if n > self.k:
                top = np.argpartition(points * n + by_id, n - self.k, axis=1)[:, n - self.k :]
                points, found = np.take_along_axis(points, top, axis=1), ids[top]
            else:
                found = np.broadcast_to(ids, points.shape)
            points = np.concatenate([self.points[mine], points], axis=1)
            found = np.concatenate([self.ids[mine], found], axis=1)
            best = np.lexsort((found, ~points), axis=1)[:, : self.k]
            self.points[mine] = np.take_along_axis(points, best, axis=1)
            self.ids[mine] = np.take_along_axis(found, best, axis=1)

    def _merge(self, which: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, hits: np.ndarray):
        """The scores at the places ``hits`` of the matrix of queries and rows."""
        query, row = np.divmod(hits, len(ids))
        points = np.rint(np.einsum("ij,ij->i", asked[query], rows[row]) * SCALE).astype("int64")
        mine = np.unique(query)
        owner = np.concatenate([np.repeat(mine, self.k), query])
        points = np.concatenate([self.points[which[mine]].ravel(), points])
        found = np.concatenate([self.ids[which[mine]].ravel(), ids[row]])
        order = np.lexsort((found, ~points, owner))
        starts = np.searchsorted(owner[order], mine)
        kept = order[starts[:, None] + np.arange(self.k)[None, :]]
        self.points[which[mine]] = points[kept]
        self.ids[which[mine]] = found[kept]

    def found(self, query_ids: np.ndarray) -> list[pa.Array]:
        row, place = np.nonzero(self.points > np.iinfo("int64").min)
        return [
            pa.array(query_ids[row]),
            pa.array(self.ids[row, place]),
            pa.array(self.points[row, place]),
        ]


def _scan(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Corpus tasks score the queries, which the caller has checked to be few."""
    table = queries.select("query_id", "vector", "cell").toArrow()
    cells = table["cell"].to_numpy()
    distinct = np.unique(cells)
    shared = queries.sparkSession.sparkContext.broadcast(
        (
            table["query_id"].to_numpy(),
            matrix(table["vector"]),
            {c: np.flatnonzero(cells == c) for c in distinct},
        )
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors, members = shared.value
        best = Best(len(query_ids), k)
        for batch in batches:
            cells = batch["cell"].to_numpy(zero_copy_only=False)
            ids, rows = batch["id"].to_numpy(), matrix(batch["vector"])
            for cell in np.unique(cells):
                if cell in members:
                    here = cells == cell
                    best.add(members[cell], vectors, ids[here], rows[here])
        yield pa.RecordBatch.from_arrays(best.found(query_ids), schema=FOUND)

    if len(distinct) <= 1:
        wanted = corpus.where(F.col("cell") == distinct.tolist()[0]) if len(distinct) else corpus.where("false")
    else:
        # As few as the queries. Prunes partitions where the table is laid out by cell; the
        # comparison tells the optimiser that the join selects.
        asked = queries.select("cell").distinct().where(F.col("cell") >= distinct.tolist()[0])
        wanted = corpus.join(F.broadcast(asked), "cell", "left_semi")
    return wanted.select("id", "vector", "cell").mapInArrow(score, FOUND_DDL)


def _blocks(queries: DataFrame, corpus: DataFrame, k: int, query_rows: int, corpus_rows: int) -> DataFrame:
    """Both sides in blocks of bounded size; every pair of blocks is one group.

    A row is copied once per block of the other side in its cell, so the blocks
    are as large as a task can hold.
    """

    def parts(df: DataFrame, name: str, block_rows: int) -> DataFrame:
        blocks = F.ceil(F.count("*") / block_rows).cast("int")
        return df.groupBy("cell").agg(blocks.alias(name))

    sizes = parts(queries, "query_parts", query_rows).join(parts(corpus, "corpus_parts", corpus_rows), "cell")

    def cut(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        mine, theirs = own.replace("parts", "part"), other.replace("parts", "part")
        return (
            df.join(sizes, "cell")
            .withColumn(mine, F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop(own, other)
        )

    left = cut(queries, "query_id", "query_parts", "corpus_parts")
    right = cut(corpus, "id", "corpus_parts", "query_parts")
    group = ["cell", "query_part", "corpus_part"]

    def score(query_block: pa.Table, corpus_block: pa.Table) -> pa.Table:
        query_ids = query_block["query_id"].to_numpy()
        best = Best(len(query_ids), k)
        if len(query_ids):
            best.add(
                np.arange(len(query_ids)),
                matrix(query_block["vector"]),
                corpus_block["id"].to_numpy(),
                matrix(corpus_block["vector"]),
            )
        return pa.Table.from_arrays(best.found(query_ids), schema=FOUND)

    return (
        left.select("query_id", "vector", *group)
        .groupBy(*group)
        .cogroup(right.select("id", "vector", *group).groupBy(*group))
        .applyInArrow(score, FOUND_DDL)
    )


def candidates(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """At least the k best rows of every query, as ``(query_id, id, points)``.

    ``queries`` is ``(query_id, vector, cell)``, a row per cell to search, and
    should be a stored table because it is sized first; ``corpus`` is
    ``(id, vector, cell)``.
    """
    size = queries.agg(
        F.count("*").alias("rows"),
        F.max(F.size("vector")).alias("dim"),
        F.min(F.size("vector")).alias("least"),
    ).first()
    if size["dim"] != size["least"]:
        raise ValueError(f"query vectors of dimension {size['least']} and {size['dim']}")
    # A task holds the vectors of its queries and k results for each.
    vector_bytes = (size["dim"] or 1) * 8
    query_bytes = max(vector_bytes, k * RESULT_BYTES)
    if size["rows"] * query_bytes <= broadcast_bytes:
        return _scan(queries, corpus, k)
    return _blocks(queries, corpus, k, max(1, block_bytes // query_bytes), max(1, block_bytes // vector_bytes))


def best_k(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates of every query as ``(query_id, rank, id, score)``."""
    by_score = Window.partitionBy("query_id").orderBy(F.desc("points"), F.asc("id"))
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", (F.col("points") / SCALE).alias("score"))
    )


def each_once(queries: DataFrame, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Search every distinct query once and give its results to all its copies.

    ``queries`` is ``(query_id, vector)``, with ``cell`` if it matters. They are
    stored and counted first; unless most are copies, ``run`` gets them as they
    are. Copies of a frequent query would otherwise meet copies of a frequent
    vector pair by pair.
    """
    parts = F.transform("vector", lambda x: x.cast("string"))
    cell = [c for c in queries.columns if c == "cell"]
    asked = stage(queries.withColumn("digest", F.md5(F.array_join(parts, ","))), "query")
    same = ["digest", *cell]
    size = asked.agg(
        F.count("*").alias("rows"), F.count_distinct(*same).alias("distinct")
    ).first()
    if size["rows"] <= 2 * size["distinct"]:
        return run(asked.drop("digest"))
    first = stage(
        asked.groupBy(*same).agg(
            F.min("query_id").alias("query_id"), F.any_value("vector").alias("vector")
        ),
        "distinct",
    )
    found = run(first.drop("digest")).withColumnRenamed("query_id", "first_id")
    copies = asked.select("query_id", *same).join(
        first.select(*same, F.col("query_id").alias("first_id")), same
    )
    return copies.join(found, "first_id").select("query_id", "rank", "id", "score")


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 3,
    where: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """The k most similar rows of ``corpus (id, embedding)`` per query.

    ``queries`` is ``(query_id, embedding)``, a stored table of distinct ones if
    ``stored`` says so; ``where`` limits the corpus before anything is scored.
    """
    if where is not None:
        corpus = corpus.where(where)
    one_cell = F.lit(0).cast("long").alias("cell")
    vectors = corpus.select("id", F.col("embedding").alias("vector"), one_cell)

    def run(asked: DataFrame) -> DataFrame:
        return best_k(candidates(asked, vectors, k, broadcast_bytes), k)

    asked = queries.select("query_id", F.col("embedding").alias("vector"), one_cell)
    return run(asked) if stored else each_once(asked, run)


def knn_within(
    queries: DataFrame,
    corpus: DataFrame,
    group: str,
    k: int = 3,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As ``knn``, but a query sees only rows that share its ``group``."""
    cell = F.col(group).alias("cell")
    named = queries.where(cell.isNotNull())
    vectors = corpus.select("id", F.col("embedding").alias("vector"), cell)
    return each_once(
        named.select("query_id", F.col("embedding").alias("vector"), cell),
        lambda asked: best_k(candidates(asked, vectors, k, broadcast_bytes), k),
    )


def with_payload(found: DataFrame, corpus: DataFrame, *columns: str) -> DataFrame:
    """Add payload columns to search results by id.

    Vectors and payload stay apart until only k rows per query are left. The
    results are stored and counted: if they are few enough to travel, the
    payload is not shuffled.
    """
    few = stage(found, "found")
    if few.count() * FOUND_BYTES <= BROADCAST_BYTES:
        few = F.broadcast(few)
    return corpus.select("id", *columns).join(few, "id").select(
        "query_id", "rank", "id", *columns, "score"
    )
