"""A vector index that is kept in a folder, opened by name and changed in place.

Cells come in two levels. Coarse centroids are few and travel to every task; a vector's
own cell is found among those of its coarse cell, which are joined to it by that. The
number of cells follows the number of rows.

    rows/segment=s/coarse=c     id, vector, cell, distance to the coarse centroid, attributes
    payload/segment=s/range=r   id, columns that only results need, by ranges of ids
    dead/segment=s              ids whose rows in earlier segments no longer count
    coarse, cells /segment=s    centroids of the build of that segment
    manifest/generation=g       one file: settings, and rows and radius of every live folder

A build, a sync and a merge each add a segment and then one manifest, whose file appears
at once. Readers hold on to the generation they opened. Nothing that is listed is ever
rewritten: a sync writes delta files for the cells it touches, a merge rewrites the cells
that have several segments or dead rows, and all others keep their files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.vectors import unit
from corpusloom.operators.index import MAX_CENTROID_BYTES, VectorIndex, assign_cells, check_vectors, nearest_cells
from corpusloom.operators.search import BROADCAST_BYTES, best_k, candidates, each_once, matrix
from corpusloom.session import stage

ROWS_PER_CELL = 500
# Training takes a hash sample: so many rows per coarse centroid, and per cell.
TRAIN_ROWS = 256
FINE_TRAIN_ROWS = 64
MAX_FINE = 4096
# A cell's number is its coarse cell's number times this, plus its place there.
SPAN = 1 << 16
BLOCK_ROWS = 100_000
IDS_PER_RANGE = 1_000_000
PROBES = 32
WIDER = 4
SEED = 7
MANIFEST_DDL = "kind string, segment int, coarse int, rows long, radius double, value string"


def index_home(root: str, name: str) -> str:
    """The folder of the index ``name`` below ``root``."""
    if not name or name.strip("/") != name or name.startswith("."):
        raise ValueError(f"no name for an index: {name!r}")
    return f"{root.rstrip('/')}/{name}"


def _share(key: str, wanted: Column, of: Column) -> Column:
    """Does a row belong to a hash sample of about ``wanted`` out of ``of`` rows?"""
    scale = 1 << 30
    drawn = F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(scale))
    return drawn < wanted.cast("double") * scale / of


def _spherical(vectors: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of rows by cosine; never more than there are different rows."""
    rng = np.random.default_rng(SEED)
    distinct = np.unique(vectors, axis=0)
    centers = distinct[np.sort(rng.permutation(len(distinct))[:cells])]
    for _ in range(rounds):
        near = np.concatenate([(part @ centers.T).argmax(axis=1) for part in np.array_split(vectors, 1 + len(vectors) // 4096)])
        sums = np.zeros_like(centers)
        np.add.at(sums, near, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(length > 0, sums / np.maximum(length, 1e-300), centers)
    return centers


def _train_coarse(vectors: DataFrame, rows: int, cells: int) -> np.ndarray:
    """Coarse centroids, by k-means over a stored sample of unit vectors."""
    wanted = F.lit(TRAIN_ROWS * cells)
    sample = stage(
        vectors.where(_share("id", wanted, F.lit(max(1, rows)))).select(unit(F.col("vector")).alias("u")), "training"
    )
    if sample.isEmpty():
        sample = vectors.select(unit(F.col("vector")).alias("u"))
    features = sample.select(array_to_vector("u").alias("features"))
    return np.array(KMeans(k=cells, seed=SEED, maxIter=10).fit(features).clusterCenters()) if cells > 1 else np.array(
        [sample.select(F.posexplode("u").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x")).orderBy("at").toPandas()["x"]]
    )


def _train_cells(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(coarse, cell, centroid)``: the cells of every coarse cell, from a sample of it.

    ``sizes`` is ``(coarse, members, fine)``, a row per coarse cell; the sample is ``FINE_TRAIN_ROWS`` per cell,
    so a group is bounded by ``MAX_FINE`` cells.
    """
    out = pa.schema([("coarse", pa.int32()), ("cell", pa.int64()), ("centroid", pa.list_(pa.float64()))])

    def train(group: pa.Table) -> pa.Table:
        coarse, fine = group["coarse"][0].as_py(), group["fine"][0].as_py()
        # In order of ids, so that a rerun gives the same cells.
        group = group.sort_by("id")
        centers = _spherical(matrix(group["vector"]), fine)
        return pa.Table.from_arrays(
            [
                pa.array([coarse] * len(centers), pa.int32()),
                pa.array(coarse * SPAN + np.arange(len(centers))),
                pa.array(list(centers), pa.list_(pa.float64())),
            ],
            schema=out,
        )

    sampled = placed.join(F.broadcast(sizes), "coarse").where(
        _share("id", F.col("fine") * FINE_TRAIN_ROWS, F.col("members")) | (F.col("members") <= FINE_TRAIN_ROWS)
    )
    return sampled.select("id", "vector", "coarse", "fine").groupBy("coarse").applyInArrow(
        train, "coarse int, cell long, centroid array<double>"
    )


def _in_cells(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """``placed`` with the cell of every row, the most similar one of its coarse cell.

    Rows meet the centroids of their coarse cell in blocks of bounded size, so a coarse
    cell with a third of all rows is spread like any other.
    """
    sizes = placed.groupBy("coarse").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = placed.join(F.broadcast(sizes), "coarse").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    ).drop("blocks")
    centers = cells.join(F.broadcast(sizes), "coarse").select(
        "coarse", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "cell", "centroid"
    )
    names = [*placed.columns, "cell"]
    schema = StructType([*placed.schema.fields]).add("cell", "long", False)

    def assign(block: pa.Table, own: pa.Table) -> pa.Table:
        block = block.select(placed_names)
        if len(block) == 0:
            return block.append_column("cell", pa.array([], pa.int64()))
        own = own.sort_by("cell")
        centers, numbers = matrix(own["centroid"]), own["cell"].to_numpy()
        vectors = matrix(block["vector"])
        step = max(1, 4_000_000 // len(centers))
        near = [(vectors[a : a + step] @ centers.T).argmax(axis=1) for a in range(0, len(vectors), step)]
        return block.append_column("cell", pa.array(numbers[np.concatenate(near)]))

    placed_names = names[:-1]
    return rows.groupBy("coarse", "block").cogroup(centers.groupBy("coarse", "block")).applyInArrow(assign, schema)


@dataclass
class NamedIndex:
    """One generation of the index in ``home``; ``open_index`` and ``create_index`` make it."""

    spark: SparkSession
    home: str
    generation: int
    settings: dict
    live: list[dict] = field(repr=False)

    # Where things are

    @property
    def dim(self) -> int:
        return self.settings["dim"]

    def _path(self, kind: str, segment: int) -> str:
        return f"{self.home}/{kind}/segment={segment}"

    def _columns(self, which: str) -> list[str]:
        return StructType.fromDDL(self.settings[which]).names if self.settings[which] else []

    def _read(self, kind: str, segments: list[int], ddl: str) -> DataFrame:
        schema = f"{ddl}, segment int"
        if not segments:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", f"{self.home}/{kind}")
        return read.parquet(*(self._path(kind, s) for s in segments))

    def _segments(self, kind: str) -> list[int]:
        return sorted({r["segment"] for r in self.live if r["kind"] == kind})

    def coarse(self) -> np.ndarray:
        """The coarse centroids; their number is bounded by the build."""
        table = self.spark.read.parquet(self._path("coarse", self.settings["build"])).orderBy("coarse")
        return np.array([r["centroid"] for r in table.collect()])

    def cells(self) -> DataFrame:
        """``(coarse, cell, centroid)`` of every cell."""
        return self.spark.read.schema("coarse int, cell long, centroid array<double>").parquet(
            self._path("cells", self.settings["build"])
        )

    def rows(self) -> DataFrame:
        """Live rows ``(id, vector, cell, distance, coarse, segment, attributes)``.

        Which folders count is a filter on partition columns, known before the scan.
        """
        more = f", {self.settings['attributes']}" if self.settings["attributes"] else ""
        ddl = f"id long, vector array<float>, cell long, distance double{more}, coarse int"
        by_segment: dict[int, list[int]] = {}
        for r in self.live:
            if r["kind"] == "rows":
                by_segment.setdefault(r["segment"], []).append(r["coarse"])
        table = self._read("rows", sorted(by_segment), ddl)
        listed = F.lit(False)
        for segment, coarse in by_segment.items():
            listed = listed | ((F.col("segment") == segment) & F.col("coarse").isin(coarse))
        table = table.where(listed)
        dead = self._segments("dead")
        if dead:
            gone = self._read("dead", dead, "id long, coarse int").select(
                F.col("id").alias("_id"), F.col("segment").alias("_since")
            )
            table = table.join(gone, (F.col("id") == F.col("_id")) & (F.col("segment") < F.col("_since")), "left_anti")
        return table

    def payload(self) -> DataFrame:
        """Payload of all segments, by ranges of ids; the newest of an id counts."""
        more = f", {self.settings['payload']}" if self.settings["payload"] else ""
        return self._read("payload", self._segments("payload"), f"id long{more}, range long")

    def table(self) -> DataFrame:
        """The indexed table ``(id, embedding, attributes, payload)`` as it stands."""
        rows = self.rows().select("id", F.col("vector").alias("embedding"), *self._columns("attributes"))
        return self.with_payload(rows) if self.settings["payload"] else rows

    def vector_index(self) -> VectorIndex:
        """The coarse cells as an index for exact pruned search; radii come from the manifest."""
        radii = np.full(self.settings["coarse"], -1.0)
        for r in self.live:
            if r["kind"] == "rows":
                radii[r["coarse"]] = max(radii[r["coarse"]], r["radius"])
        rows = self.rows().select("id", "vector", F.col("coarse").cast("long").alias("cell"), "distance")
        return VectorIndex(rows, self.coarse(), radii)

    # Search

    def _probes(self, asked: DataFrame, nprobe: int) -> DataFrame:
        """``(query_id, vector, cell)``: the ``nprobe`` most similar cells of the nearest coarse ones."""
        among = nearest_cells(asked, self.coarse(), max(4, nprobe))
        cells = self.cells().select(
            F.col("cell").alias("id"), F.col("centroid").alias("vector"), F.col("coarse").cast("long").alias("cell")
        )
        found = best_k(candidates(stage(among, "coarse-probes"), cells, nprobe), nprobe)
        return asked.join(found.select("query_id", F.col("id").alias("cell")), "query_id")

    def search(
        self,
        queries: DataFrame,
        k: int = 3,
        nprobe: int = PROBES,
        where: Column | None = None,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """Approximate ``(query_id, rank, id, score)`` of ``queries (query_id, embedding)``.

        Reads the probed coarse cells only: they prune partitions while the query runs, and
        ``where``, over the attributes, is pushed into their scan. Queries that find fewer
        than k rows, as a strict filter may cause, probe more cells until all are searched.
        Where all are, a query meets every live row once and no list of its cells is made.
        """
        total = self.settings["cells"]

        def run(asked: DataFrame) -> DataFrame:
            asked, probed, done = stage(asked, "asked"), min(nprobe, total), None
            while True:
                if probed < total:
                    probes = stage(self._probes(asked, probed), "probes")
                    rows = self._within(probes, where)
                else:
                    everywhere = F.lit(0).cast("long").alias("cell")
                    probes = asked.select("query_id", "vector", everywhere)
                    rows = self.rows() if where is None else self.rows().where(where)
                    rows = rows.select("id", "vector", everywhere)
                found = stage(candidates(probes, rows, k, broadcast_bytes), "found")
                best = best_k(found, k)
                if probed < total:
                    full = best.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
                    full = stage(full, "full")
                    asked = stage(asked.join(full, "query_id", "left_anti"), "short")
                    if not asked.isEmpty():
                        kept = best.join(full, "query_id", "left_semi")
                        done = kept if done is None else done.unionByName(kept)
                        probed = min(total, probed * WIDER)
                        continue
                return best if done is None else done.unionByName(best)

        return each_once(queries.select("query_id", F.col("embedding").alias("vector")), run)

    def _within(self, probes: DataFrame, where: Column | None) -> DataFrame:
        """Live rows of the probed coarse cells."""
        rows = self.rows() if where is None else self.rows().where(where)
        # One row per coarse cell; the filter tells the optimiser that it selects.
        coarse = F.floor(F.col("cell") / SPAN).cast("int")
        asked = stage(probes.select(coarse.alias("coarse")).distinct(), "probed").where("coarse >= 0")
        return rows.join(F.broadcast(asked), "coarse", "left_semi").select("id", "vector", "cell")

    def with_payload(self, found: DataFrame) -> DataFrame:
        """Add the payload to rows with an ``id``: only their ranges of ids are read."""
        columns = self._columns("payload")
        rows = stage(found.withColumn("range", F.floor(F.col("id") / IDS_PER_RANGE)), "found")
        wanted = rows.select("id", "range").distinct()
        ranges = stage(wanted.select("range").distinct(), "ranges").where(F.col("range").isNotNull() & (F.col("range") > -(1 << 62)))
        held = self.payload().join(F.broadcast(ranges), "range", "left_semi")
        newest = (
            held.join(wanted.drop("range"), "id", "left_semi")
            .groupBy("id")
            .agg(F.max_by(F.struct(*columns), "segment").alias("payload"))
        )
        return rows.drop("range").join(newest, "id", "left").select(*found.columns, "payload.*")

    # Change

    def _commit(self, settings: dict, live: list[dict]) -> NamedIndex:
        """Add the next generation; another writer of the same one is an error."""
        rows = [("settings", 0, 0, 0, 0.0, json.dumps(settings, sort_keys=True))]
        rows += [(r["kind"], r["segment"], r["coarse"], r["rows"], r["radius"], "") for r in live]
        generation = self.generation + 1
        self.spark.createDataFrame(rows, MANIFEST_DDL).coalesce(1).write.parquet(
            f"{self.home}/manifest/generation={generation}"
        )
        return NamedIndex(self.spark, self.home, generation, settings, live)

    def _write_rows(self, placed: DataFrame, segment: int) -> list[dict]:
        """Write rows that know their cells; gives the manifest's entries."""
        path = self._path("rows", segment)
        columns = ["id", "vector", "cell", "distance", *self._columns("attributes"), "coarse"]
        placed.select(*columns).sortWithinPartitions("coarse", "cell").write.partitionBy("coarse").parquet(path)
        written = self.spark.read.schema("coarse int, distance double").parquet(path)
        sizes = written.groupBy("coarse").agg(F.count("*").alias("rows"), F.max("distance").alias("radius"))
        return [{"kind": "rows", "segment": segment, **r.asDict()} for r in sizes.collect()]

    def _write_payload(self, rows: DataFrame, segment: int) -> list[dict]:
        columns = self._columns("payload")
        if not columns:
            return []
        by_range = rows.select("id", *columns, F.floor(F.col("id") / IDS_PER_RANGE).alias("range"))
        by_range.repartition("range").sortWithinPartitions("range", "id").write.partitionBy("range").parquet(
            self._path("payload", segment)
        )
        return [{"kind": "payload", "segment": segment, "coarse": 0, "rows": 0, "radius": 0.0}]

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows ``(id, embedding, ...)`` with coarse cell, distance and cell."""
        vectors = rows.select("id", F.col("embedding").cast("array<float>").alias("vector"), *self._columns("attributes"))
        return _in_cells(assign_coarse(vectors, self.coarse()), self.cells())

    def sync(self, changes: DataFrame, mark: str | None = None) -> NamedIndex:
        """Apply ``(id, change, embedding, attributes, payload)`` as one new segment.

        An update or a delete makes earlier rows of its id dead. Applying changes again
        gives the same table. With a ``mark`` the changes are applied once: a mark that the
        index holds already leaves it as it is.
        """
        if mark is not None and mark in self.settings["marks"]:
            return self
        changes = stage(changes, "changes")
        upserts = changes.where(F.col("change") != "delete")
        if not changes.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError("an id has several changes")
        check_vectors(upserts.select("id", F.col("embedding").alias("vector")), self.dim, unique=False)
        segment = self.settings["segments"] + 1
        held = self.rows().select("id", "coarse").join(changes.select("id"), "id", "left_semi")
        held.select("id", "coarse").write.parquet(self._path("dead", segment))
        touched = self.spark.read.schema("id long, coarse int").parquet(self._path("dead", segment))
        dead = [
            {"kind": "dead", "segment": segment, "coarse": r["coarse"], "rows": r["count"], "radius": 0.0}
            for r in touched.groupBy("coarse").count().collect()
        ]
        added = self._write_rows(self._placed(upserts), segment) if not upserts.isEmpty() else []
        payload = self._write_payload(upserts, segment) if added else []
        settings = {**self.settings, "segments": segment}
        if mark is not None:
            settings["marks"] = [*self.settings["marks"], mark][-1000:]
        return self._commit(settings, self.live + dead + added + payload)

    def size(self) -> int:
        """Rows listed, dead ones less, by the manifest."""
        count = {kind: sum(r["rows"] for r in self.live if r["kind"] == kind) for kind in ("rows", "dead")}
        return count["rows"] - count["dead"]

    def retrained(self, rows_per_cell: int = ROWS_PER_CELL) -> NamedIndex:
        """The same table under cells trained on it as it is now, as a new generation."""
        root, _, name = self.home.rpartition("/")
        return create_index(
            root, name, self.table(), self.dim, self._columns("attributes"), self._columns("payload"),
            rows_per_cell, self.settings["marks"],
        )

    def merge(self, all_cells: bool = False) -> NamedIndex:
        """Rewrite coarse cells that have several segments or dead rows, and only those."""
        parts: dict[int, int] = {}
        for r in self.live:
            if r["kind"] == "rows":
                parts[r["coarse"]] = parts.get(r["coarse"], 0) + 1
        worn = {c for c, n in parts.items() if n > 1 or all_cells}
        worn |= {r["coarse"] for r in self.live if r["kind"] == "dead"}
        if not worn:
            return self
        segment = self.settings["segments"] + 1
        rows = self.rows().where(F.col("coarse").isin(sorted(worn)))
        spread = rows.repartition("coarse", F.pmod(F.floor(F.col("cell") % SPAN), F.lit(16)))
        empty = rows.isEmpty()
        added = [] if empty else self._write_rows(spread, segment)
        kept = [r for r in self.live if r["kind"] == "payload" or (r["kind"] == "rows" and r["coarse"] not in worn)]
        return self._commit({**self.settings, "segments": segment}, kept + added)


def assign_coarse(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """All columns, the nearest coarse centroid and the distance to it."""
    placed = assign_cells(vectors, centroids, "coarse")
    return placed.withColumn("coarse", F.col("coarse").cast("int"))


def create_index(
    root: str,
    name: str,
    corpus: DataFrame,
    dim: int,
    attributes: list[str] | None = None,
    payload: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    marks: list[str] | None = None,
) -> NamedIndex:
    """Index ``corpus (id, embedding, attributes, payload)`` under a name.

    Attributes can be filtered by in a search, payload comes with its results. An index of
    that name gets a new generation; those who have it open keep theirs.
    """
    spark, home = corpus.sparkSession, index_home(root, name)
    attributes, payload = attributes or [], payload or []

    def ddl(names: list[str]) -> str:
        fields = {f.name: f for f in corpus.schema.fields}
        return ", ".join(f"`{n}` {fields[n].dataType.simpleString()}" for n in names)

    vectors = corpus.select("id", F.col("embedding").cast("array<float>").alias("vector"), *attributes)
    check_vectors(vectors, dim)
    rows = vectors.count()
    cells = max(1, rows // rows_per_cell)
    coarse = max(1, min(round(cells**0.5), MAX_CENTROID_BYTES // (dim * 8)))
    before = _newest(spark, home)
    segment = 1 + (before.settings["segments"] if before else 0)
    settings = {
        "dim": dim, "attributes": ddl(attributes), "payload": ddl(payload), "build": segment, "segments": segment,
        "marks": marks or [], "trained_on": rows,
    }
    index = NamedIndex(spark, home, before.generation if before else 0, settings, [])
    if rows:
        centroids = _train_coarse(vectors, rows, coarse)
    else:
        centroids = np.zeros((1, dim))
    table = spark.createDataFrame(
        [(i, i * SPAN, [float(x) for x in c]) for i, c in enumerate(centroids)],
        "coarse int, cell long, centroid array<double>",
    ).coalesce(1)
    table.write.parquet(index._path("coarse", segment))
    placed = stage(assign_coarse(vectors, centroids), "placed")
    fine = F.least(F.ceil(F.count("*") / rows_per_cell), F.lit(MAX_FINE)).cast("int")
    sizes = stage(placed.groupBy("coarse").agg(F.count("*").alias("members"), fine.alias("fine")), "sizes")
    trained = stage(_train_cells(placed, sizes), "cells")
    # A coarse cell without rows is one cell, for rows to come.
    alone = table.join(trained.select("coarse"), "coarse", "left_anti")
    trained.unionByName(alone).write.parquet(index._path("cells", segment))
    settings |= {"coarse": len(centroids), "cells": max(1, index.cells().count())}
    live = index._write_rows(_in_cells(placed, index.cells()), segment) if rows else []
    if rows:
        live += index._write_payload(corpus, segment)
    return index._commit(settings, live)


def _newest(spark: SparkSession, home: str) -> NamedIndex | None:
    try:
        manifest = spark.read.schema(f"{MANIFEST_DDL}, generation int").parquet(f"{home}/manifest")
    except AnalysisException:
        return None
    generation = manifest.agg(F.max("generation").alias("g")).first()["g"]
    if generation is None:
        return None
    # A row per live folder, at most as many as coarse cells and segments give.
    entries = [r.asDict() for r in manifest.where(F.col("generation") == generation).collect()]
    settings = [json.loads(r["value"]) for r in entries if r["kind"] == "settings"]
    if len(settings) != 1:
        raise RuntimeError(f"two writers committed generation {generation} of {home}")
    live = [
        {k: r[k] for k in ("kind", "segment", "coarse", "rows", "radius")} for r in entries if r["kind"] != "settings"
    ]
    return NamedIndex(spark, home, generation, settings[0], live)


def index_exists(spark: SparkSession, root: str, name: str) -> bool:
    return _newest(spark, index_home(root, name)) is not None


def open_index(spark: SparkSession, root: str, name: str) -> NamedIndex:
    """The newest generation of an index, in any session."""
    found = _newest(spark, index_home(root, name))
    if found is None:
        raise FileNotFoundError(f"no index {name!r} below {root}")
    return found
