"""Token ids in Arrow files of equal-length sequences, read back by memory map.

Documents are encoded in ascending order of their id. A part file is an Arrow
stream file whose batches hold two fixed-size-list columns, the ids and a mask
(1 for a token, 0 for padding), so that sequence i of a file is a slice of a
buffer and needs no copy. Only the last sequence of a part is padded. A second
small file lists the documents of the part with the place of their first id.

Tasks write under names of their own and report what they wrote; only reported
files are read, so files of lost or repeated tasks do no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import crc_of, encoder
from corpusloom.session import new_path, stage

LENGTH = 2048
BATCH_SEQUENCES = 256
LISTED = pa.schema([("doc_id", pa.int64()), ("position", pa.int64()), ("n_tokens", pa.int64())])
REPORT = pa.schema(
    [
        ("part", pa.int64()),
        ("name", pa.string()),
        ("docs", pa.int64()),
        ("tokens", pa.int64()),
        ("sequences", pa.int64()),
    ]
)
READ = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int64()),
    ]
)


def ids_schema(vocabulary: int, length: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema(
        [("input_ids", pa.list_(kind, length)), ("mask", pa.list_(pa.uint8(), length))]
    )


class PartWriter:
    """Writes the two files of one part."""

    def __init__(self, folder: str, name: str, schema: pa.Schema, length: int):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.schema, self.length = schema, length
        self.kind = schema.field("input_ids").type.value_type
        self.streams = [
            self.files.open_output_stream(f"{root}/{name}.{end}") for end in ("ids.arrow", "docs.arrow")
        ]
        self.ids = ipc.new_file(self.streams[0], schema)
        self.docs = ipc.new_file(self.streams[1], LISTED)
        self.held: list[np.ndarray] = []
        self.waiting = self.tokens = self.rows = self.sequences = 0

    def add(self, keys: list[int | None], flat: np.ndarray, counts: np.ndarray) -> None:
        begins = self.tokens + np.cumsum(counts) - counts
        self.docs.write_batch(
            pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(begins), pa.array(counts)], schema=LISTED
            )
        )
        self.rows += len(keys)
        self.tokens += len(flat)
        self.held.append(flat)
        self.waiting += len(flat)
        if self.waiting >= self.length * BATCH_SEQUENCES:
            flat = np.concatenate(self.held)
            full = len(flat) // self.length * self.length
            for at in range(0, full, self.length * BATCH_SEQUENCES):
                self._write(flat[at : min(full, at + self.length * BATCH_SEQUENCES)], None)
            self.held, self.waiting = [flat[full:]], len(flat) - full

    def _write(self, flat: np.ndarray, padded: int | None) -> None:
        mask = np.ones(len(flat), "uint8")
        if padded:
            flat = np.concatenate([flat, np.zeros(padded, flat.dtype)])
            mask = np.concatenate([mask, np.zeros(padded, "uint8")])
        columns = [pa.array(flat.astype(self.kind.to_pandas_dtype())), pa.array(mask)]
        self.ids.write_batch(
            pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns],
                schema=self.schema,
            )
        )
        self.sequences += len(flat) // self.length

    def close(self) -> None:
        if self.waiting:
            flat = np.concatenate(self.held)
            self._write(flat, -len(flat) % self.length)
        for writer in (self.ids, self.docs, *self.streams):
            writer.close()


class PartReader:
    """Random access to the sequences and documents of one part."""

    def __init__(self, folder: str, name: str):
        files, root = fs.FileSystem.from_uri(folder)

        def opened(end: str):
            path = f"{root}/{name}.{end}"
            if isinstance(files, fs.LocalFileSystem):
                return pa.memory_map(path)
            return files.open_input_file(path)

        self.ids = ipc.open_file(opened("ids.arrow"))
        self.docs = ipc.open_file(opened("docs.arrow"))
        self.length = self.ids.schema.field("input_ids").type.list_size
        counts = [self.ids.get_batch(i).num_rows for i in range(self.ids.num_record_batches)]
        self.ends = np.cumsum([0, *counts]) * self.length
        self.at, self.loaded = -1, None

    def _batch(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a batch, as views of the file where it is mapped."""
        if at != self.at:
            batch = self.ids.get_batch(at)
            views = [batch[c].flatten().to_numpy() for c in ("input_ids", "mask")]
            self.at, self.loaded = at, views
        return self.loaded

    def slices(self, position: int, count: int) -> Iterator[np.ndarray]:
        """The ids from a position on, one view for every batch they lie in."""
        while count:
            at = int(np.searchsorted(self.ends, position, side="right")) - 1
            ids, mask = self._batch(at)
            begin = position - int(self.ends[at])
            view = ids[begin : begin + count]
            if not mask[begin : begin + len(view)].all():
                raise ValueError("a document reaches into padding")
            yield view
            position, count = position + len(view), count - len(view)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for i in range(self.docs.num_record_batches):
            batch = self.docs.get_batch(i)
            yield from zip(*(batch[c].to_pylist() for c in LISTED.names), strict=True)


def write_ids(
    docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, folder: str | None = None
) -> tuple[str, DataFrame]:
    """Write all documents ``(doc_id, text)``; the folder and what was written.

    A null or empty text is the end id alone, documents with a null doc_id come
    first, rows with equal ids follow each other in order of a hash of their text,
    other columns are not read. An empty table writes nothing.
    """
    folder = folder or new_path(docs.sparkSession, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, writer = encoder(tokenizer), None
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            if writer is None and batch.num_rows:
                schema = ids_schema(tokens.tokenizer.get_vocab_size(), length)
                writer = PartWriter(folder, name, schema, length)
            keys = batch["doc_id"].to_pylist()
            for at in range(0, len(keys), 512):
                own = tokens.encode(batch["text"][at : at + 512].to_pylist(), end_id)
                writer.add(keys[at : at + 512], *own)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [[part], [name], [writer.rows], [writer.tokens], [writer.sequences]], schema=REPORT
            )

    inside = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", inside)
        .sortWithinPartitions("doc_id", inside)
    )
    report = ordered.mapInArrow(write, "part long, name string, docs long, tokens long, sequences long")
    return folder, stage(report, "ids-report")


def read_ids(folder: str, report: DataFrame) -> DataFrame:
    """Every document as read from the files, with its place in the whole stream.

    One task reads one part; the report has one row per part.
    """
    spark = report.sparkSession
    parts = sorted((r["part"], r["name"], r["tokens"]) for r in report.collect())
    before = np.cumsum([0, *(tokens for _, _, tokens in parts)]).tolist()
    places = [(p, name, b) for (p, name, _), b in zip(parts, before, strict=False)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, name, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = PartReader(folder, name)
                rows: list[tuple] = []

                def full(rows=rows):
                    columns = list(zip(*rows, strict=True)) or [()] * len(READ)
                    return pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, READ, strict=True)], schema=READ
                    )

                for key, position, count in reader.documents():
                    crc = 0
                    for view in reader.slices(position, count):
                        crc = crc_of(view, crc)
                    rows.append((key, base + position, count, crc, part))
                    if len(rows) == 10_000:
                        yield full()
                        rows.clear()
                yield full()

    named = spark.createDataFrame(places, "part long, name string, base long")
    return named.repartition(max(1, len(places)), "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, part long"
    )


def ids_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH) -> DataFrame:
    return read_ids(*write_ids(docs, tokenizer, end_id, length))
