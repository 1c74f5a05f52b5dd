"""The corpus job: files to chunks to embeddings, in batch and incrementally."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.vectors import BatchEmbedder
from corpusloom.operators.chunking import chunk_sentences
from corpusloom.operators.embedding import embed
from corpusloom.operators.keys import assign_ids, digits_for, new_rows
from corpusloom.operators.models import Parser, extract_text, parsed, quarantined
from corpusloom.session import arrow_batch, spread, stage
from corpusloom.sources.files import BINARY_FILE, binary_files, table_stream
from corpusloom.streaming.drain import drain

# Chunk size, overlap, and files per Arrow batch while parsing.
CHUNK_TOKENS = 500
CHUNK_OVERLAP = 10
FILES_PER_BATCH = 10

KEY = ["url", "chunk_idx"]
CHUNKS = "url string, chunk_idx long, content string, n_tokens long"
# What every stage holds, whether or not it has rows yet.
STAGES = {
    "raw": BINARY_FILE,
    "extracted": "path string, modificationTime timestamp, length long, text string, error string",
    "chunks": CHUNKS,
    "embedded": f"{CHUNKS}, embedding array<float>",
    "published": f"id long, {CHUNKS}, embedding array<float>",
}


def embedded_chunks(
    documents: DataFrame,
    embedder: BatchEmbedder,
    dim: int,
    max_tokens: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Stored table ``(id, url, chunk_idx, content, embedding)`` of ``(url, text)``."""
    chunks = chunk_sentences(spread(documents.select("url", "text")), "text", max_tokens, overlap)
    stored = stage(chunks, "chunks")
    numbered = assign_ids(stored, KEY, hex_digits=digits_for(stored.count()))
    embedded = embed(numbered, "content", embedder, dim)
    return stage(
        embedded.select("id", "url", "chunk_idx", "content", "n_tokens", "embedding"), "corpus"
    )


@dataclass
class CorpusJob:
    """Incremental stages from a folder of files to embedded chunks.

    Every stage is one stream that appends to its own folder below ``home`` and
    keeps its progress there. ``run`` may be repeated at any time: it handles
    new files only.
    """

    spark: SparkSession
    landing: str
    home: str
    make_parser: Callable[[], Parser]
    embedder: BatchEmbedder
    dim: int
    glob: str = "*.pdf"
    max_tokens: int = CHUNK_TOKENS
    overlap: int = CHUNK_OVERLAP

    def _path(self, name: str) -> str:
        return f"{self.home}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAGES[name]).parquet(self._path(name))

    def _drain(self, stream: DataFrame, name: str) -> None:
        drain(stream, self._path(f"progress/{name}"), path=self._path(name))

    def ingest(self) -> None:
        self._drain(binary_files(self.spark, self.landing, self.glob), "raw")

    def parse(self) -> None:
        raw = self._stream("raw")
        with arrow_batch(self.spark, FILES_PER_BATCH):
            self._drain(extract_text(raw, self.make_parser), "extracted")

    def chunk(self) -> None:
        texts = parsed(self._stream("extracted")).select(F.col("path").alias("url"), "text")
        self._drain(chunk_sentences(texts, "text", self.max_tokens, self.overlap), "chunks")

    def embed(self) -> None:
        self._drain(embed(self._stream("chunks"), "content", self.embedder, self.dim), "embedded")

    def _stream(self, name: str) -> DataFrame:
        return table_stream(self.spark, self._path(name), STAGES[name])

    def failed(self) -> DataFrame:
        return quarantined(self.read("extracted"))

    def publish(self) -> None:
        """Give new chunks the next ids; chunks published before keep theirs."""
        rows, existing = self.read("embedded"), None
        if self.published:
            existing = self.read("published")
            rows = new_rows(rows, existing, KEY)
        rows = stage(rows, "unpublished")
        numbered = assign_ids(rows, KEY, existing, digits_for(rows.count()))
        stage(numbered, "numbered").write.mode("append").parquet(self._path("published"))

    @property
    def published(self) -> bool:
        try:
            return bool(self.read("published").columns)
        except AnalysisException:
            return False

    def run(self) -> DataFrame:
        for step in (self.ingest, self.parse, self.chunk, self.embed, self.publish):
            step()
        return self.read("published")
