"""Hierarchical packing of documents into sequences of several lengths.

Documents are routed to context-size tiers: whole windows are cut off, and what
is left of a document goes to the smallest tier that holds it. Tiers are packed
from the longest to the shortest. A document of a tier opens a sequence of the
tier's length; its gap is filled from shorter tiers, by the longest document that
fits and at last by a cut of one that does not. Sequences of a tier are then dealt
to step groups so that the attention costs of the groups are near equal.

Every task packs its own documents in blocks of bounded size, so nothing is
shuffled and a lost task is repeated alone. What is open at the end of a block is
carried to the next one; the last open sequence of a task is cut at powers of two.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corpusloom.llm.tokens import WORDS_KEPT, encoder

TIERS = (256, 512, 1024, 2048)
BLOCK_TOKENS = 2_000_000
GROUP_TOKENS = 32_768
SHORTEST = 16
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("sequence_tokens", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, tier int, step_group long, ids binary"
)

# A piece is (document, start, length); a sequence is (tier, pieces).
Piece = tuple[int, int, int]
Sequence = tuple[int, list[Piece]]


class Shelf:
    """Unplaced pieces in order of their length."""

    def __init__(self):
        self.held: list[tuple[int, int, int]] = []

    def add(self, piece: Piece) -> None:
        doc, start, length = piece
        bisect.insort(self.held, (length, doc, start))

    def longest(self, most: int) -> Piece | None:
        """Takes away the longest piece of at most this length."""
        at = bisect.bisect_right(self.held, (most, float("inf"), 0))
        if at == 0:
            return None
        length, doc, start = self.held.pop(at - 1)
        return doc, start, length

    def shortest_over(self, least: int) -> Piece | None:
        """Takes away the shortest piece that is longer than this."""
        at = bisect.bisect_right(self.held, (least, float("inf"), 0))
        if at == len(self.held):
            return None
        length, doc, start = self.held.pop(at)
        return doc, start, length


def pack_block(pieces: list[Piece], tiers=TIERS) -> tuple[list[Sequence], list[Piece]]:
    """Full sequences of the pieces, and the pieces that fill none."""
    window, done, shelf = tiers[-1], [], Shelf()
    for doc, start, length in pieces:
        while length >= window:
            done.append((window, [(doc, start, window)]))
            start, length = start + window, length - window
        if length:
            shelf.add((doc, start, length))
    for tier, below in zip(reversed(tiers), [*reversed(tiers[:-1]), 0], strict=True):
        while (opened := shelf.longest(tier)) is not None:
            if opened[2] <= below:
                shelf.add(opened)
                break
            row, gap = [opened], tier - opened[2]
            while gap:
                if (filler := shelf.longest(min(gap, tier))) is None:
                    if (filler := shelf.shortest_over(gap)) is None:
                        break
                    doc, start, length = filler
                    shelf.add((doc, start + gap, length - gap))
                    filler = (doc, start, gap)
                row.append(filler)
                gap -= filler[2]
            if gap:
                # Nothing is left on the shelf.
                return done, row
            done.append((tier, row))
    return done, [(d, s, n) for n, d, s in shelf.held]


def cut_at_powers(pieces: list[Piece], window: int, shortest: int = SHORTEST) -> list[Sequence]:
    """Sequences of falling powers of two for the last pieces, and one short rest."""
    left, done = list(pieces), []
    total = sum(p[2] for p in left)
    while total:
        size = min(window, 1 << (total.bit_length() - 1))
        if size < shortest:
            size = total
        row, gap = [], size
        while gap:
            doc, start, length = left.pop(0)
            take = min(length, gap)
            row.append((doc, start, take))
            if take < length:
                left.insert(0, (doc, start + take, length - take))
            gap -= take
        done.append((size if size & (size - 1) == 0 else window, row))
        total -= size
    return done


def step_groups(sequences: list[Sequence], group_tokens: int = GROUP_TOKENS) -> list[int]:
    """A group for every sequence: equal tiers, near equal attention cost.

    Sequences of a tier are dealt to and fro in order of their cost.
    """
    group, first = [0] * len(sequences), 0
    for tier in sorted({t for t, _ in sequences}):
        own = [i for i, (t, _) in enumerate(sequences) if t == tier]
        cost = {i: sum(n * n for _, _, n in sequences[i][1]) for i in own}
        own.sort(key=lambda i, cost=cost: (-cost[i], i))
        groups = max(1, round(len(own) * tier / group_tokens))
        for place, i in enumerate(own):
            lap, step = divmod(place, groups)
            group[i] = first + (groups - 1 - step if lap % 2 else step)
        first += groups
    return group


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    block_tokens: int = BLOCK_TOKENS,
    group_tokens: int = GROUP_TOKENS,
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """Pieces of all documents ``(doc_id, text)`` with their place and their ids.

    ``ids`` holds little-endian unsigned 32-bit integers. ``tiers`` rises by powers
    of two to the window. A null or empty text is the end id alone, a null doc_id
    stays null, repeated rows are packed each for itself, other columns are not
    read, and an empty table gives no rows. Documents of any length are cut.
    """
    if any(t & (t - 1) for t in tiers) or sorted(set(tiers)) != list(tiers):
        raise ValueError("tiers must be rising powers of two")
    window = tiers[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer, words_kept)
        base = TaskContext.get().partitionId() << 36
        number = groups = 0
        ids: list[np.ndarray] = []
        keys: list[int | None] = []
        pieces: list[Piece] = []
        held = 0

        def rows(sequences: list[Sequence]) -> Iterator[pa.RecordBatch]:
            nonlocal number, groups
            of = step_groups(sequences, group_tokens)
            out: list[tuple] = []
            size = 0
            for (tier, row), group in zip(sequences, of, strict=True):
                offset, total = 0, sum(p[2] for p in row)
                for doc, start, length in row:
                    out.append(
                        (keys[doc], start, length, len(ids[doc]), base + number, offset, total,
                         tier, base + groups + group, ids[doc][start : start + length].tobytes())
                    )
                    offset += length
                number += 1
                size += total
                if size >= 1 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PIECES, strict=True)],
                        schema=PIECES,
                    )
                    out, size = [], 0
            groups += max(of, default=-1) + 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PIECES, strict=True)],
                    schema=PIECES,
                )

        for batch in batches:
            names, texts = batch["doc_id"].to_pylist(), batch["text"]
            for at in range(0, len(names), 256):
                flat, counts = tokens.encode(texts[at : at + 256].to_pylist(), end_id)
                for key, own in zip(
                    names[at : at + 256], np.split(flat, np.cumsum(counts)[:-1]), strict=True
                ):
                    pieces.append((len(ids), 0, len(own)))
                    keys.append(key)
                    ids.append(own)
                    held += len(own)
                if held >= block_tokens:
                    done, pieces = pack_block(pieces, tiers)
                    yield from rows(done)
                    # Only documents with an unplaced piece go on.
                    live = sorted({p[0] for p in pieces})
                    move = {d: i for i, d in enumerate(live)}
                    ids, keys = [ids[d] for d in live], [keys[d] for d in live]
                    pieces = [(move[d], s, n) for d, s, n in pieces]
                    held = sum(p[2] for p in pieces)
        if pieces:
            done, rest = pack_block(pieces, tiers)
            yield from rows(done + cut_at_powers(rest, window))

    return docs.select("doc_id", "text").mapInArrow(run, PIECES_DDL)
