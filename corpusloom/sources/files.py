"""File and table sources."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

# Fixed value: columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def binary_files(
    spark: SparkSession, folder: str, glob: str = "*.pdf", files_per_batch: int = 100_000
) -> DataFrame:
    """Stream of files in a folder and below, new ones only on each run.

    A large backlog is taken in several batches, so a failed run repeats one.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _bounded(reader, files_per_batch: int | None, bytes_per_batch: int | None):
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader


def table_stream(
    spark: SparkSession,
    folder: str,
    schema,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Stream of a parquet folder, rows added since the last run only.

    A backlog is taken in batches of so many files, or of about so many bytes.
    """
    reader = _bounded(spark.readStream.schema(schema), files_per_batch, bytes_per_batch)
    return reader.parquet(folder)


def catalog_stream(
    spark: SparkSession,
    name: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Stream of a table of the catalog, by its name, as ``table_stream``."""
    return _bounded(spark.readStream, files_per_batch, bytes_per_batch).table(name)


def land_texts(texts: DataFrame, folder: str) -> None:
    """A file for each row of a one-column table of texts, ending in a newline; null is an empty text.

    On a shared local file system the tasks write the files themselves, as Spark's writer starts a
    process for every file there to set its permissions. A repeated task replaces its own files.
    An empty table leaves one empty file, as Spark's writer does.
    """
    url, default = urlparse(folder), texts.sparkSession.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if (url.scheme or urlparse(default).scheme) != "file":
        texts.write.option("maxRecordsPerFile", 1).text(folder)
        return
    path = unquote(url.path) if url.scheme else folder
    os.makedirs(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = TaskContext.get(), 0
        part, attempt = own.partitionId(), own.taskAttemptId()
        for batch in batches:
            for text in batch.column(0):
                name = f"part-{part:05d}-{number:09d}.txt"
                # Readers leave out names that begin with a line.
                with open(f"{path}/_{attempt}-{name}", "wb") as file:
                    file.write((text.as_py() or "").encode() + b"\n")
                os.replace(f"{path}/_{attempt}-{name}", f"{path}/{name}")
                number += 1
        yield pa.RecordBatch.from_pydict({"n": [number]})

    if not sum(r["n"] for r in texts.mapInArrow(write, "n long").collect()):
        open(f"{path}/part-00000.txt", "wb").close()
