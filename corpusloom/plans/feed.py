"""The corpus as a feed of changes: files that come, change and go, up to the index.

A scan lists the landing folder and appends what is new, other or gone since the last one
to a feed of ``(path, modificationTime, length, change, version)``. A stream takes the feed
batch by batch. A batch parses, cuts and embeds its files only, writes everything under its
batch number and brings the index up to date under a mark, so a batch that is replayed
writes the same folders again and leaves the index as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.vectors import BatchEmbedder
from corpusloom.operators.chunking import chunk_sentences
from corpusloom.operators.embedding import embed
from corpusloom.operators.keys import assign_ids
from corpusloom.operators.models import Parser, extract_text, parsed, quarantined
from corpusloom.operators.named_index import ROWS_PER_CELL, NamedIndex, create_index, index_exists, open_index
from corpusloom.plans.corpus import CHUNK_OVERLAP, CHUNK_TOKENS, FILES_PER_BATCH, KEY
from corpusloom.session import arrow_batch, stage
from corpusloom.sources.files import BINARY_FILE, table_stream
from corpusloom.streaming.drain import drain_batches

FEED = "path string, modificationTime timestamp, length long, change string, version long"
# Files in one batch of the feed; their paths pass through the driver.
BATCH_FILES = 10_000
# The index is trained anew once it holds so many times the rows of its training.
GROWTH = 4
ATTRIBUTES, PAYLOAD = ["n_tokens"], ["url", "chunk_idx", "content"]


@dataclass
class CorpusFeed:
    """A landing folder kept in step with the index ``name`` below ``home``."""

    spark: SparkSession
    landing: str
    home: str
    make_parser: Callable[[], Parser]
    embedder: BatchEmbedder
    dim: int
    name: str = "corpus"
    glob: str = "*.pdf"
    max_tokens: int = CHUNK_TOKENS
    overlap: int = CHUNK_OVERLAP
    batch_files: int = BATCH_FILES
    rows_per_cell: int = ROWS_PER_CELL

    def _path(self, table: str) -> str:
        return f"{self.home}/{table}"

    def _read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        try:
            return spark.read.schema(ddl).parquet(self._path(table))
        except AnalysisException:
            return spark.createDataFrame([], ddl)

    def listing(self) -> DataFrame:
        """What lies in the landing folder; contents are not read."""
        files = (
            self.spark.read.format("binaryFile")
            .schema(BINARY_FILE)
            .option("pathGlobFilter", self.glob)
            .option("recursiveFileLookup", "true")
            .load(self.landing)
        )
        return files.select("path", "modificationTime", "length")

    def scan(self) -> int:
        """Append the changes since the last scan to the feed; gives their number."""
        feed = self._read(self.spark, "feed", FEED)
        last = feed.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"]
        known = (
            feed.groupBy("path")
            .agg(F.max_by(F.struct("modificationTime", "length", "change"), "version").alias("was"))
            .where("was.change <> 'delete'")
            .select("path", "was")
        )
        seen = F.col("modificationTime").isNotNull()
        same = (F.col("modificationTime") == F.col("was.modificationTime")) & (F.col("length") == F.col("was.length"))
        change = F.when(F.col("was").isNull(), "insert").when(~seen, "delete").when(~same, "update")
        changes = stage(
            self.listing()
            .join(known, "path", "full")
            .withColumn("change", change)
            .where(F.col("change").isNotNull())
            .select("path", "modificationTime", "length", "change", F.lit(last + 1).cast("long").alias("version")),
            "changes",
        )
        count = changes.count()
        if count:
            # A file of the feed is at most one batch.
            files = -(-count // self.batch_files)
            changes.repartition(files, "path").write.mode("append").parquet(self._path("feed"))
        return count

    def _texts(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        files = spark.read.format("binaryFile").load(paths) if paths else spark.createDataFrame([], BINARY_FILE)
        # The path as it stands in the feed.
        return extract_text(files.select("path", "content"), self.make_parser)

    def apply(self, batch: DataFrame, number: int) -> None:
        """Take one batch of the feed through all stages to the index."""
        spark = batch.sparkSession
        newest = F.max_by(F.col("change"), "version").alias("change")
        changes = stage(batch.groupBy("path").agg(newest), "batch")
        wanted = changes.where("change <> 'delete'").join(self.listing().select("path"), "path", "left_semi")
        paths = sorted(r["path"] for r in wanted.collect())
        with arrow_batch(spark, FILES_PER_BATCH):
            extracted = stage(self._texts(spark, paths), "extracted")
        quarantined(extracted).write.mode("overwrite").parquet(f"{self._path('failed')}/batch={number}")
        texts = parsed(extracted).select(F.col("path").alias("url"), "text")
        chunks = stage(chunk_sentences(texts, "text", self.max_tokens, self.overlap), "chunks")
        # Ids follow those of earlier batches, whichever way this batch was run before.
        tops = self._read(spark, "tops", "top long, batch long").where(F.col("batch") < number)
        top = tops.agg(F.max("top").alias("top")).first()["top"] or 0
        numbered = assign_ids(chunks, KEY).withColumn("id", F.col("id") + top)
        embedded = embed(numbered, "content", self.embedder, self.dim)
        folder = f"{self._path('chunks')}/batch={number}"
        embedded.select("id", "url", "chunk_idx", "content", "n_tokens", "embedding").write.mode("overwrite").parquet(folder)
        rows = spark.read.schema(embedded_schema()).parquet(folder)
        highest = rows.agg(F.coalesce(F.max("id"), F.lit(top)).alias("top")).select(F.col("top").cast("long"))
        highest.write.mode("overwrite").parquet(f"{self._path('tops')}/batch={number}")
        self._index(spark, rows, changes, number)

    def _index(self, spark: SparkSession, rows: DataFrame, changes: DataFrame, number: int) -> None:
        mark, added = f"batch-{number}", rows.withColumn("change", F.lit("insert"))
        if not index_exists(spark, self.home, self.name):
            create_index(self.home, self.name, rows, self.dim, ATTRIBUTES, PAYLOAD, self.rows_per_cell, [mark])
            return
        index = open_index(spark, self.home, self.name)
        replaced = changes.where("change <> 'insert'").select(F.col("path").alias("url"))
        if not replaced.isEmpty():
            # Only then are earlier chunks looked at, by two columns.
            held = self._read(spark, "chunks", "id long, url string, batch long").where(F.col("batch") < number)
            gone = held.join(replaced, "url", "left_semi").select("id", F.lit("delete").alias("change"))
            added = added.unionByName(gone, allowMissingColumns=True)
        index = index.sync(added, mark)
        if index.size() > GROWTH * max(1, index.settings["trained_on"]):
            index.retrained(self.rows_per_cell)

    def drain(self) -> int:
        """Apply all that the feed holds and this job has not seen; gives the number of batches."""
        feed = table_stream(self.spark, self._path("feed"), FEED, files_per_batch=1)
        return drain_batches(feed, self._path("progress"), self.apply)

    def run(self) -> NamedIndex | None:
        """Scan and drain, at any time; the index, or none while no file ever came."""
        self.scan()
        if self._read(self.spark, "feed", FEED).isEmpty():
            return None
        self.drain()
        return self.index()

    def index(self) -> NamedIndex:
        return open_index(self.spark, self.home, self.name)

    def failed(self) -> DataFrame:
        """Files that could not be parsed, with the batch and the error."""
        return self._read(self.spark, "failed", "path string, error string, batch long")


def embedded_schema() -> str:
    return "id long, url string, chunk_idx long, content string, n_tokens long, embedding array<float>"
