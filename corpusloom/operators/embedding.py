"""Embedding text columns with a caller-supplied batch function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import BatchEmbedder

# Fixed value: texts per call that the served embedding model accepts.
MODEL_BATCH = 150


def embed(
    df: DataFrame,
    text_col: str,
    embedder: BatchEmbedder,
    dim: int,
    out: str = "embedding",
    batch: int = MODEL_BATCH,
) -> DataFrame:
    """Add an ``array<float>`` column, calling ``embedder`` on at most ``batch`` texts.

    The embedder reaches each task once and keeps its state over all batches. Texts leave
    Arrow a call at a time, so a task holds no more of them as Python strings.
    A reply with another number of vectors or another dimension fails the job.
    """

    @F.arrow_udf("array<float>")
    def embed_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            vectors = np.empty((len(texts), dim), dtype="float32")
            for at in range(0, len(texts), batch):
                asked = texts[at : at + batch].to_pylist()
                reply = np.asarray(embedder(asked), dtype="float32")
                if reply.shape != (len(asked), dim):
                    raise ValueError(
                        f"embedder gave {reply.shape} for {len(asked)} texts of dimension {dim}"
                    )
                vectors[at : at + batch] = reply
            ends = np.arange(len(texts) + 1, dtype="int32") * dim
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))

    return df.withColumn(out, embed_batches(F.col(text_col)))
