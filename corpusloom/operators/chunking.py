"""Token-bounded chunks of documents, computed inside the row without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text, let

# Matches a sentence with its leading punctuation, so that no text is lost.
SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+"


def _words(text: Column) -> Column:
    """Words of an already cleaned text; none for an empty one."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _windows(words: Column, width: int, step: int, overlap: int) -> Column:
    """Slices of ``width`` words every ``step`` words, each with some new word."""
    last = F.greatest(F.lit(0), F.ceil((F.size(words) - overlap) / step) - 1).cast("int")
    slices = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(words, i * step + 1, F.lit(width))
    )
    return F.when(F.size(words) > 0, slices).otherwise(F.array().cast("array<array<string>>"))


def sentences_of(cleaned: Column) -> Column:
    """The sentences of a cleaned text, trimmed, none of them empty."""
    matches = F.regexp_extract_all(cleaned, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(matches, lambda s: F.trim(s)), lambda s: s != "")


def _pieces(cleaned: Column, budget: int) -> Column:
    """Sentences as word arrays; a sentence over the budget is cut into windows."""
    return F.flatten(
        F.transform(
            sentences_of(cleaned),
            lambda s: let(_words(s), lambda words: _windows(words, budget, budget, 0)),
        )
    )


def _chunk_starts(sizes: Column, budget: int) -> Column:
    """One-based position of the first piece of every chunk, packed greedily.

    Only a closed chunk appends to the array, so the fold copies little even
    for a very long document.
    """
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(budget + 1).alias("filled"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(state: Column, size: Column) -> Column:
        opens = state["filled"] + size > budget
        here = state["at"] + 1
        return F.struct(
            here.alias("at"),
            F.when(opens, size).otherwise(state["filled"] + size).alias("filled"),
            F.when(opens, F.concat(state["starts"], F.array(here)))
            .otherwise(state["starts"])
            .alias("starts"),
        )

    return F.aggregate(sizes, start, step, lambda state: state["starts"])


def _carried(sizes: Column, first: Column, start: Column, overlap: int) -> Column:
    """How many pieces before ``start`` fit the overlap, none before ``first``."""
    low = F.greatest(first, start - overlap)
    none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("pieces"))

    def step(state: Column, size: Column) -> Column:
        fits = state["words"] + size <= overlap
        return F.struct(
            F.when(fits, state["words"] + size).otherwise(F.lit(overlap + 1)).alias("words"),
            F.when(fits, state["pieces"] + 1).otherwise(state["pieces"]).alias("pieces"),
        )

    before = F.reverse(F.slice(sizes, low, start - low))
    return F.aggregate(before, none, step, lambda state: state["pieces"])


def sentence_chunks(text: Column, max_tokens: int = 500, overlap: int = 10) -> Column:
    """Array of ``(content, n_tokens)`` chunks of whole sentences.

    Every chunk holds at most ``max_tokens`` words, the trailing sentences
    carried over from the chunk before (at most ``overlap`` words) included.
    """
    budget = max_tokens - overlap

    def build(doc: Column) -> Column:
        pieces, sizes, starts = doc["pieces"], doc["sizes"], doc["starts"]

        def chunk(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(pieces) + 1)
            carried = F.when(i == 0, F.lit(0)).otherwise(
                _carried(sizes, F.coalesce(F.get(starts, i - 1), F.lit(1)), start, overlap)
            )
            return let(
                carried,
                lambda n: let(
                    F.flatten(F.slice(pieces, start - n, end - start + n)),
                    lambda words: F.struct(
                        F.array_join(words, " ").alias("content"),
                        F.size(words).cast("long").alias("n_tokens"),
                    ),
                ),
            )

        return F.transform(starts, chunk)

    return let(
        _pieces(clean_text(text), budget),
        lambda pieces: let(
            F.transform(pieces, F.size),
            lambda sizes: let(
                F.struct(
                    pieces.alias("pieces"),
                    sizes.alias("sizes"),
                    _chunk_starts(sizes, budget).alias("starts"),
                ),
                build,
            ),
        ),
    )


def window_chunks(text: Column, max_tokens: int = 500, overlap: int = 10) -> Column:
    """Array of ``(content, n_tokens)`` fixed word windows with overlap."""
    return F.transform(
        let(
            _words(clean_text(text)),
            lambda words: _windows(words, max_tokens, max_tokens - overlap, overlap),
        ),
        lambda words: F.struct(
            F.array_join(words, " ").alias("content"),
            F.size(words).cast("long").alias("n_tokens"),
        ),
    )


def explode_chunks(df: DataFrame, chunks: Column, text_col: str) -> DataFrame:
    """One row per chunk; ``text_col`` gives way to chunk_idx, content, n_tokens.

    Other columns pass through. Documents without any chunk drop out.
    """
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(chunks).alias("chunk_idx", "chunk")).select(
        *keep,
        F.col("chunk_idx").cast("long").alias("chunk_idx"),
        F.col("chunk.content").alias("content"),
        F.col("chunk.n_tokens").alias("n_tokens"),
    )


def chunk_sentences(
    df: DataFrame, text_col: str = "text", max_tokens: int = 500, overlap: int = 10
) -> DataFrame:
    return explode_chunks(df, sentence_chunks(F.col(text_col), max_tokens, overlap), text_col)


def chunk_windows(
    df: DataFrame, text_col: str = "text", max_tokens: int = 500, overlap: int = 10
) -> DataFrame:
    return explode_chunks(df, window_chunks(F.col(text_col), max_tokens, overlap), text_col)
