"""I-Match fingerprints over several randomised lexicons.

Terms that are neither too frequent nor too rare form the lexicon. A document keeps
its distinct terms of the lexicon, sorted, and a hash of them is its fingerprint. One
changed term changes that hash, so further hashes are taken over random subsets of
the lexicon, of falling sizes: the share of subsets on which two documents agree tells
how alike they are. Subsets that hold no term of either document tell nothing.

A term is in the lexicon by its share of documents, so the lexicon has at most (mean
number of distinct terms) / (least share) terms however large the corpus is, and may
travel to the tasks.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.neighbours import with_successors
from corpusloom.session import stage

LEAST_SHARE, MOST_SHARE = 0.0005, 0.2
RATES = (4, 16, 64, 256)
SUBSETS = 12
HASH_BYTES = 4
TERMS_HELD = 400_000
BROADCAST_TERMS = 1_000_000
SEED = 17
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def terms(text: str) -> list[bytes]:
    """Runs of characters between ASCII white space, ASCII letters in lower case."""
    return text.encode().lower().split()


def _counted(docs: DataFrame, share: float | None) -> DataFrame:
    """Document frequencies of terms as counted by single tasks, ``(term, n)``.

    With a share only terms that reach it within the documents of one count are given:
    a term that has the share over all documents has it in at least one count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        rows = 0

        def full() -> Iterator[pa.RecordBatch]:
            own = held.items()
            if share is not None:
                own = [(t, n) for t, n in own if n >= share * rows]
            own = list(own)
            for at in range(0, len(own), 50_000):
                some = own[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())],
                    names=["term", "n"],
                )

        for batch in batches:
            for text in batch["text"].to_pylist():
                held.update(set(terms(text or "")))
                rows += 1
                if len(held) >= TERMS_HELD:
                    yield from full()
                    held.clear()
                    rows = 0
        yield from full()

    return docs.select("text").mapInArrow(count, "term binary, n long")


def lexicon(
    docs: DataFrame,
    least_share: float = LEAST_SHARE,
    most_share: float = MOST_SHARE,
    broadcast_terms: int = BROADCAST_TERMS,
) -> list[bytes]:
    """Sorted terms with a share of documents within the band, counted over all documents.

    A first pass finds the terms that may have the least share, a second one counts
    those; they travel to the counts if they are few and are joined otherwise.
    """
    rows = docs.count()
    maybe = stage(_counted(docs, least_share).select("term").distinct(), "lexicon-maybe")
    few = maybe.count() <= broadcast_terms
    counts = _counted(docs, None).join(F.broadcast(maybe) if few else maybe, "term", "left_semi")
    kept = (
        counts.groupBy("term")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least_share * rows) & (F.col("n") <= max(1.0, most_share * rows)))
    )
    return sorted(bytes(t) for t in kept.select("term").toArrow()["term"].to_pylist())


class Fingerprints:
    """Hashes of documents over the lexicon and its random subsets."""

    def __init__(self, words: list[bytes], seed: int = SEED):
        self.place = {w: i for i, w in enumerate(words)}
        self.code = np.fromiter((_hash(w) for w in words), "uint64", len(words))
        # A term's part in the subsets follows from its characters alone.
        member = [np.ones(len(words), bool)]
        for salt in np.random.default_rng(seed).integers(0, 1 << 63, len(RATES) * SUBSETS):
            rate = RATES[(len(member) - 1) // SUBSETS]
            member.append(_mixed(self.code ^ np.uint64(salt)) % np.uint64(rate) == 0)
        self.member = np.stack(member, axis=1)

    def of(self, text: str) -> np.ndarray:
        """One hash per subset, 0 where the document has none of its terms.

        A document without terms of the lexicon has one hash, of all its terms.
        """
        own = set(terms(text))
        at = np.array(sorted(p for p in map(self.place.get, own) if p is not None), "int64")
        out = np.zeros(self.member.shape[1], "uint32")
        if not len(at):
            out[0] = _short(b" ".join(sorted(own)))
            return out
        code, member = self.code[at], self.member[at]
        for j in np.flatnonzero(member.any(axis=0)):
            out[j] = _short(code[member[:, j]].tobytes())
        return out


def _hash(value: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little")


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all bits."""
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def _short(value: bytes) -> int:
    """A hash that is never 0."""
    return int.from_bytes(hashlib.blake2b(value, digest_size=HASH_BYTES).digest(), "little") or 1


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """1 for equal fingerprints; else the share of telling subsets that agree.

    The smallest subsets of which half tell something are asked: there one changed
    term does not decide.
    """
    if np.array_equal(one, two):
        return 1.0
    telling = (one != 0) | (two != 0)
    for level in range(len(RATES) - 1, -1, -1):
        columns = slice(1 + level * SUBSETS, 1 + (level + 1) * SUBSETS)
        said = int(telling[columns].sum())
        if 2 * said >= SUBSETS or (level == 0 and said):
            return float((telling & (one == two))[columns].sum() / said)
    return 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, words: list[bytes], seed: int = SEED) -> DataFrame:
    """Fingerprints of all documents ``(doc_id, text)`` and of their edited texts.

    A null text is empty. Documents with a null doc_id come first, repeated rows follow
    each other, after the last document comes the first, a single document follows
    itself. Other columns are not read, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(b"\n".join(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Fingerprints(shared.value.split(b"\n") if shared.value else [], seed)
        rows: list[tuple] = []
        held: tuple | None = None
        for batch in batches:
            for key, text, part, extra in zip(
                *(batch[c].to_pylist() for c in ("doc_id", "text", "part", "extra")), strict=True
            ):
                text = text or ""
                own = hashes.of(text)
                if held is not None and held[3] == part:
                    before, old, code, _ = held
                    new = edited(old, text)
                    changed = hashes.of(new)
                    rows.append(
                        (
                            before,
                            len(old),
                            hashlib.sha256(new.encode()).hexdigest(),
                            code.astype(">u4").tobytes().hex(),
                            changed.astype(">u4").tobytes().hex(),
                            likeness(code, changed),
                            likeness(code, own),
                        )
                    )
                held = None if extra else (key, text, own, part)
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT
                )
                rows.clear()

    ddl = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return with_successors(docs).mapInArrow(run, ddl)
