"""Vector index: coarse cells over a vector table, its search and its sync."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.vectors import unit
from corpusloom.operators.search import (
    BROADCAST_BYTES,
    SCALE,
    TILE_SCORES,
    best_k,
    candidates,
    each_once,
    matrix,
)
from corpusloom.session import new_path, stage

MAX_CENTROID_BYTES = 128 * 1024 * 1024
ROWS_PER_FILE = 500_000


@dataclass
class VectorIndex:
    """Stored rows ``(id, vector, cell, distance)`` and the centroids.

    The centroids are the one thing that travels to every task; their number is
    chosen at build time and checked against ``MAX_CENTROID_BYTES``.
    """

    rows: DataFrame
    centroids: np.ndarray
    known_radii: np.ndarray | None = None

    def radii(self) -> np.ndarray:
        """Largest distance of a row to its centroid, per cell; -1 for an empty cell."""
        if self.known_radii is not None:
            return self.known_radii
        out = np.full(len(self.centroids), -1.0)
        for row in self.rows.groupBy("cell").agg(F.max("distance").alias("radius")).collect():
            out[row["cell"]] = row["radius"]
        return out


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (
        (vectors**2).sum(axis=1)[:, None]
        + (centroids**2).sum(axis=1)[None, :]
        - 2 * vectors @ centroids.T
    )
    return np.sqrt(np.maximum(square, 0))


def _tiles(rows: int, cells: int) -> Iterator[slice]:
    """Row ranges whose distances to all centroids fit one bounded matrix."""
    step = max(1, TILE_SCORES // max(1, cells))
    for at in range(0, rows, step):
        yield slice(at, at + step)


def assign_cells(vectors: DataFrame, centroids: np.ndarray, name: str = "cell") -> DataFrame:
    """All columns with the nearest centroid and the distance to it; the first of equal ones."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    schema = StructType([*vectors.schema.fields]).add(name, "long").add("distance", "double")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows, near = matrix(batch["vector"]), []
            for tile in _tiles(len(rows), len(shared.value)):
                away = _distances(rows[tile], shared.value)
                near.append((away.argmin(axis=1), away.min(axis=1)))
            cell, distance = (np.concatenate(part) for part in zip(*near))
            yield batch.append_column(name, pa.array(cell, pa.int64())).append_column(
                "distance", pa.array(distance)
            )

    return vectors.mapInArrow(assign, schema)


def check_vectors(vectors: DataFrame, dim: int, unique: bool = True) -> None:
    """Fail on a repeated id or a vector of another dimension."""
    wrong = vectors.where(F.col("vector").isNull() | (F.size("vector") != dim))
    if not wrong.isEmpty():
        raise ValueError(f"vectors without dimension {dim}")
    if not unique:
        return
    repeated = vectors.groupBy("id").count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError("ids are not unique")


def _store(rows: DataFrame) -> DataFrame:
    """Write index rows by cell; a large cell is cut into several files."""
    spark = rows.sparkSession
    path = new_path(spark, "index")
    staged = stage(rows, "index-rows")
    files = F.ceil(F.count("*") / ROWS_PER_FILE).cast("int").alias("files")
    sizes = staged.groupBy("cell").agg(files)
    part = F.pmod(F.xxhash64("id"), F.col("files"))
    (
        staged.join(sizes, "cell")
        .repartition("cell", part)
        .drop("files")
        .write.partitionBy("cell")
        .parquet(path)
    )
    stored = spark.read.schema("id long, vector array<float>, distance double, cell long")
    return stored.parquet(path).select("id", "vector", "cell", "distance")


def build_index(
    corpus: DataFrame,
    dim: int,
    cells: int = 16,
    train_on: DataFrame | None = None,
    iterations: int = 10,
    centroids: np.ndarray | None = None,
) -> VectorIndex:
    """Index ``corpus (id, embedding)`` by trained cells, or by given ``centroids``.

    The cells only steer which rows a search reads, so they may be trained on a
    smaller table (``train_on``) without any effect on exact results. All centroids
    travel to every task here; ``named_index`` has two levels for more cells.
    """
    if (cells if centroids is None else len(centroids)) * dim * 8 > MAX_CENTROID_BYTES:
        raise ValueError("too many cells for this dimension; use a named index")
    vectors = corpus.select("id", F.col("embedding").alias("vector"))
    check_vectors(vectors, dim)
    if centroids is None:
        training = stage(
            (corpus if train_on is None else train_on).select(unit(F.col("embedding")).alias("unit")), "training"
        )
        features = training.select(array_to_vector("unit").alias("features"))
        centroids = np.array(KMeans(k=cells, seed=7, maxIter=iterations).fit(features).clusterCenters())
    return VectorIndex(_store(assign_cells(vectors, centroids)), centroids)


def _probes(queries: DataFrame, cells: int, choose, extra: str | None = None) -> DataFrame:
    """``(query_id, vector, cell)`` with the cells that ``choose`` picks per query.

    ``choose(vectors, extra column)`` gives a boolean matrix, query by cell.
    """
    schema = pa.schema(
        [("query_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("cell", pa.int64())]
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            more = batch[extra].to_numpy(zero_copy_only=False) if extra else None
            rows = matrix(batch["vector"])
            for tile in _tiles(len(rows), cells):
                row, cell = np.nonzero(choose(rows[tile], None if more is None else more[tile]))
                which = pa.array(row + tile.start)
                columns = [batch["query_id"].take(which), batch["vector"].take(which)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip([*columns, pa.array(cell)], schema)],
                    schema=schema,
                )

    return queries.mapInArrow(probe, "query_id long, vector array<double>, cell long")


def nearest_cells(queries: DataFrame, centroids: np.ndarray, nprobe: int) -> DataFrame:
    """``(query_id, vector, cell)`` with the ``nprobe`` nearest centroids of every query."""
    shared = queries.sparkSession.sparkContext.broadcast(centroids)
    nprobe = min(nprobe, len(centroids))

    def nearest(vectors: np.ndarray, _) -> np.ndarray:
        away = _distances(vectors, shared.value)
        chosen = np.argsort(away, axis=1, kind="stable")[:, :nprobe]
        picked = np.zeros(away.shape, dtype=bool)
        np.put_along_axis(picked, chosen, True, axis=1)
        return picked

    return _probes(queries, len(centroids), nearest)


def knn_probed(
    queries: DataFrame,
    index: VectorIndex,
    k: int = 3,
    nprobe: int = 4,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Approximate search: only the ``nprobe`` nearest cells of every query."""

    def run(asked: DataFrame) -> DataFrame:
        probes = stage(nearest_cells(asked, index.centroids, nprobe), "probes")
        return best_k(candidates(probes, index.rows, k, broadcast_bytes), k)

    return each_once(queries.select("query_id", F.col("embedding").alias("vector")), run)


def knn_pruned(
    queries: DataFrame,
    index: VectorIndex,
    k: int = 3,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact search that skips cells which cannot hold a result.

    The nearest cell of a query gives its k-th best score so far. By the
    triangle inequality no row of a cell is closer than the distance to the
    centroid less the cell's radius, so a cell whose bound stays below that
    score is skipped; every other cell is searched.
    """
    context = queries.sparkSession.sparkContext
    shared = context.broadcast((index.centroids, index.radii()))

    def home(vectors: np.ndarray, _=None) -> np.ndarray:
        centroids, radii = shared.value
        away = np.where(radii < 0, np.inf, _distances(vectors, centroids))
        return away.argmin(axis=1)[:, None] == np.arange(len(centroids))

    def rest(vectors: np.ndarray, reached: np.ndarray) -> np.ndarray:
        centroids, radii = shared.value
        closest = np.maximum(_distances(vectors, centroids) - radii - 1e-7, 0)
        # Unit vectors: score = 1 - distance^2 / 2. A zero vector scores 0, below the bound.
        bound = np.ceil((1 - closest**2 / 2) * SCALE) + 1
        open_cells = (bound >= reached[:, None]) & (radii >= 0)[None, :]
        return open_cells & ~home(vectors)

    cells, nothing = len(index.centroids), F.lit(-2.0 * SCALE)

    def run(asked: DataFrame) -> DataFrame:
        probes = stage(_probes(asked, cells, home), "probes")
        first = stage(candidates(probes, index.rows, k, broadcast_bytes), "found")
        kth = F.when(F.count("*") == k, F.round(F.min("score") * SCALE)).otherwise(nothing)
        reached = best_k(first, k).groupBy("query_id").agg(kth.alias("reached"))
        known = asked.join(reached, "query_id", "left").withColumn(
            "reached", F.coalesce("reached", nothing)
        )
        more = stage(_probes(known, cells, rest, "reached"), "probes")
        second = candidates(more, index.rows, k, broadcast_bytes)
        return best_k(first.unionByName(second), k)

    return each_once(queries.select("query_id", F.col("embedding").alias("vector")), run)


def index_diff(old: DataFrame, new: DataFrame, key: str, *payload: str) -> DataFrame:
    """Changes that turn ``old`` into ``new``: ``(key, change, *payload)``.

    Only a hash of the old payload is shuffled. Unchanged rows drop out; a
    deleted row has a NULL payload.
    """
    # The hash passes over NULLs, so where they are is hashed too.
    row_hash = F.xxhash64(*payload, *(F.col(c).isNull() for c in payload))
    before = old.select(key, row_hash.alias("old_hash"))
    after = new.select(key, *payload, row_hash.alias("new_hash"))
    change = (
        F.when(F.col("old_hash").isNull(), "insert")
        .when(F.col("new_hash").isNull(), "delete")
        .when(F.col("old_hash") != F.col("new_hash"), "update")
    )
    return (
        before.join(after, key, "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(key, "change", *payload)
    )


def apply_changes(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after the changes; applying them again gives the same table."""
    kept = table.join(changes.select(key), key, "left_anti")
    added = changes.where(F.col("change") != "delete").select(*table.columns)
    return kept.unionByName(added)


def sync_index(index: VectorIndex, changes: DataFrame) -> VectorIndex:
    """Apply ``(id, change, embedding)`` to an index, keeping its cells."""
    upserts = changes.where(F.col("change") != "delete")
    placed = assign_cells(
        upserts.select("id", F.col("embedding").alias("vector")), index.centroids
    )
    kept = index.rows.join(changes.select("id"), "id", "left_anti")
    return VectorIndex(
        _store(kept.select("id", "vector", "cell", "distance").unionByName(placed)),
        index.centroids,
    )
