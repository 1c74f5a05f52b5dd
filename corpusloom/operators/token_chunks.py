"""Chunks bounded by the tokens of any tokenizer.

A tokenizer enters as a counter: texts in, for each the positions where its tokens end.
One vectorised pass counts all sentences of a batch at once and cuts those that are too
long at token ends; packing and overlap are the same native folds as for words; a second
pass counts the chunks themselves. Between the passes nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text, let
from corpusloom.operators.chunking import _carried, _chunk_starts, explode_chunks, sentences_of

Counter = Callable[[Sequence[str]], list[list[int]]]
MakeCounter = Callable[[], Counter]

# Characters whose tokens are held at once, besides those of one row.
SLICE_CHARACTERS = 500_000
PIECE = pa.struct([("text", pa.string()), ("n", pa.int32())])
CHUNK = pa.struct([("content", pa.string()), ("n_tokens", pa.int64())])


def pattern_counter(pattern: str) -> MakeCounter:
    """Tokens are the matches of a pattern."""

    def make() -> Counter:
        token = re.compile(pattern)
        return lambda texts: [[m.end() for m in token.finditer(t)] for t in texts]

    return make


def width_counter(characters: int) -> MakeCounter:
    """Tokens are so many characters each, a common rule of thumb."""

    def make() -> Counter:
        return lambda texts: [[*range(characters, len(t), characters), len(t)] if t else [] for t in texts]

    return make


def tokenizer_counter(path: str) -> MakeCounter:
    """Tokens of a model's tokenizer, from its JSON file; every task loads it once."""

    def make() -> Counter:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()

        def count(texts: Sequence[str]) -> list[list[int]]:
            found = model.encode_batch(list(texts), add_special_tokens=False)
            return [[end for _, end in f.offsets] for f in found]

        return count

    return make


class Measure:
    """Counts texts as they may stand in a chunk: at its start, or after a space."""

    def __init__(self, counter: Counter):
        self.counter = counter

    def ends(self, texts: Sequence[str]) -> list[list[int]]:
        found = self.counter(texts)
        if len(found) != len(texts):
            raise ValueError(f"counter gave {len(found)} counts for {len(texts)} texts")
        return found

    def sizes(self, texts: Sequence[str]) -> list[int]:
        behind = self.ends([f" {t}" for t in texts])
        return [max(len(a), len(b)) for a, b in zip(self.ends(texts), behind, strict=True)]

    def cut(self, text: str, ends: list[int], budget: int) -> list[tuple[str, int]]:
        """A long text in pieces within the budget, at token ends while that is enough."""
        step = max(1, budget - 1)
        marks = [0, *ends[step - 1 :: step]]
        marks = sorted({*marks, len(text)})
        todo = [text[a:b].strip(" ") for a, b in zip(marks, marks[1:])][::-1]
        pieces: list[tuple[str, int]] = []
        while todo:
            piece = todo.pop()
            if not piece:
                continue
            size = self.sizes([piece])[0]
            if size <= budget or len(piece) == 1:
                pieces.append((piece, size))
            else:
                todo += [piece[len(piece) // 2 :].strip(" "), piece[: len(piece) // 2].strip(" ")]
        return pieces


def _slices(rows: pa.Array, characters: int = SLICE_CHARACTERS) -> Iterator[pa.Array]:
    """A batch of texts, or of lists of texts, in slices of about so many characters.

    Counters give a number per token; for a whole batch these are many times its text.
    """
    if pa.types.is_string(rows.type) or pa.types.is_large_string(rows.type):
        sizes = pc.fill_null(pc.utf8_length(rows), 0).to_numpy(zero_copy_only=False)
    else:
        owners = pc.list_parent_indices(rows).to_numpy(zero_copy_only=False)
        each = pc.fill_null(pc.utf8_length(pc.list_flatten(rows)), 0).to_numpy(zero_copy_only=False)
        sizes = np.bincount(owners, weights=each, minlength=len(rows))
    part = np.cumsum(sizes) // characters
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(rows)]
    for start, end in zip(cuts, cuts[1:]):
        yield rows[start:end]


def _by_slices(rows: pa.Array, one: Callable[[pa.Array], pa.Array]) -> pa.Array:
    return pa.concat_arrays([one(part) for part in _slices(rows)])


def _per_list(found: list[list], lengths: list[int], kind: pa.DataType, make) -> pa.Array:
    """Results of flattened lists, as lists again."""
    at, out = 0, []
    for n in lengths:
        out.append([make(x) for part in found[at : at + n] for x in part])
        at += n
    return pa.array(out, pa.list_(kind))


def _flat(lists: pa.Array) -> tuple[list[str], list[int]]:
    texts = lists.to_pylist()
    return [t for row in texts for t in row or []], [len(row or []) for row in texts]


def counted_pieces(sentences: Column, make_counter: MakeCounter, budget: int) -> Column:
    """Sentences as ``(text, n)``, none of more than ``budget`` tokens."""
    measure: list[Measure] = []

    @F.arrow_udf("array<struct<text string, n int>>")
    def pieces(lists: pa.Array) -> pa.Array:
        if not measure:
            measure.append(Measure(make_counter()))
        return _by_slices(lists, some)

    def some(lists: pa.Array) -> pa.Array:
        texts, lengths = _flat(lists)
        sizes, ends = measure[0].sizes(texts), measure[0].ends(texts)
        found = [
            [(t, n)] if n <= budget else measure[0].cut(t, e, budget) for t, n, e in zip(texts, sizes, ends, strict=True)
        ]
        return _per_list(found, lengths, PIECE, lambda p: {"text": p[0], "n": p[1]})

    return pieces(sentences)


def counted_contents(contents: Column, make_counter: MakeCounter, max_tokens: int) -> Column:
    """Chunk texts as ``(content, n_tokens)`` by their own count.

    A counter that finds more tokens in a text than in its sentences may leave a chunk over
    the bound; it is halved at a space, or where there is none in the middle, until none is.
    """
    measure: list[Measure] = []

    @F.arrow_udf("array<struct<content string, n_tokens bigint>>")
    def counted(lists: pa.Array) -> pa.Array:
        if not measure:
            measure.append(Measure(make_counter()))
        return _by_slices(lists, some)

    def some(lists: pa.Array) -> pa.Array:
        texts, lengths = _flat(lists)
        found = []
        for text, ends in zip(texts, measure[0].ends(texts), strict=True):
            done, todo = [], [(text, len(ends))]
            while todo:
                one, size = todo.pop()
                if size <= max_tokens or len(one) < 2:
                    done.append((one, size))
                    continue
                space = one.rfind(" ", 1, len(one) // 2 + 1)
                at = space if space > 0 else len(one) // 2
                halves = [h for h in (one[:at].strip(" "), one[at:].strip(" ")) if h]
                todo += [(h, len(e)) for h, e in zip(halves, measure[0].ends(halves), strict=True)][::-1]
            found.append(done)
        return _per_list(found, lengths, CHUNK, lambda c: {"content": c[0], "n_tokens": c[1]})

    return counted(contents)


def _contents(pieces: Column, budget: int, overlap: int) -> Column:
    """Texts of the chunks that ``(text, n)`` pieces are packed into."""

    def build(doc: Column) -> Column:
        own, sizes, starts = doc["pieces"], doc["sizes"], doc["starts"]

        def content(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(own) + 1)
            carried = F.when(i == 0, F.lit(0)).otherwise(
                _carried(sizes, F.coalesce(F.get(starts, i - 1), F.lit(1)), start, overlap)
            )
            return let(
                carried,
                lambda n: F.array_join(
                    F.transform(F.slice(own, start - n, end - start + n), lambda p: p["text"]), " "
                ),
            )

        return F.transform(starts, content)

    sizes = F.transform(pieces, lambda p: p["n"])
    return let(
        F.struct(pieces.alias("pieces"), sizes.alias("sizes")),
        lambda d: let(
            F.struct(d["pieces"].alias("pieces"), d["sizes"].alias("sizes"), _chunk_starts(d["sizes"], budget).alias("starts")),
            build,
        ),
    )


def chunk_by_tokens(
    df: DataFrame, make_counter: MakeCounter, text_col: str = "text", max_tokens: int = 500, overlap: int = 10
) -> DataFrame:
    """As ``chunk_sentences``, with a tokenizer's count: no chunk has more than ``max_tokens``.

    Only a single character of more tokens than that can exceed it.
    """
    budget = max_tokens - overlap
    if budget < 1:
        raise ValueError("the overlap leaves no room for a sentence")
    keep = [F.col(c) for c in df.columns if c != text_col]
    rows = df.select(*keep, sentences_of(clean_text(F.col(text_col))).alias("_sentences"))
    rows = rows.select(*keep, counted_pieces(F.col("_sentences"), make_counter, budget).alias("_pieces"))
    rows = rows.select(*keep, _contents(F.col("_pieces"), budget, overlap).alias("_contents"))
    return explode_chunks(rows, counted_contents(F.col("_contents"), make_counter, max_tokens), "_contents")


def tokens_in(text: Column, make_counter: MakeCounter) -> Column:
    """The number of a text's tokens; none in a null one."""
    measure: list[Measure] = []

    @F.arrow_udf("bigint")
    def number(texts: pa.Array) -> pa.Array:
        if not measure:
            measure.append(Measure(make_counter()))
        return _by_slices(texts, some)

    def some(texts: pa.Array) -> pa.Array:
        return pa.array([len(e) for e in measure[0].ends([t or "" for t in texts.to_pylist()])], pa.int64())

    return number(text)
