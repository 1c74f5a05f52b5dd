"""Audit of how filters interact: what each removes, in every order they may be applied.

Four filters look at one text: few words (A), repeated words (B), capitals (C), odd
symbols (D). The fifth (E) removes texts that a document with a smaller number has too,
anywhere in the table, and is decided by radix tries:

* Characters of the distinct texts are counted by prefix, and prefixes that hold too much
  are lengthened until every range of them holds about ``PART_BYTES``. A prefix that many
  near copies share is lengthened as far as they agree; one text is never cut.
* Every task enters its texts, in blocks of bounded bytes, into a compressed trie that
  holds the least document number where a text ends. Rows above that number are copies
  already, and go on without their text: of a group of copies one row per block is left.
* The rest is dealt out by range of its text. A task enters the whole texts of its range into one
  trie; the numbers at their ends are final, and a second walk over the rows compares.

The flags of a document are five bits. Only counts by part and bits are left for the audit,
which takes all orders of the filters over these.

Odd rows: a null text is empty; a null document number is no copy and no original; rows with
equal number and text are not copies of each other; of repeated labels the largest counts; a
null part is the empty string; a very long text is one path of its trie; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.ordering import in_order, running_totals
from corpusloom.session import stage

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
PART_BYTES = 32 * 1024 * 1024
BLOCK_BYTES = 24 * 1024 * 1024
# Bytes that a text's own row and node are taken to need.
ROW_BYTES = 200
FIRST_LETTERS, HELD_LETTERS, LONGER = 4, 64, 4
# The contract's characters.
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"

MOVED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.string()),
        ("fails", pa.int32()),
        ("range", pa.int32()),
        ("text", pa.binary()),
    ]
)
MOVED_DDL = "doc_id long, part string, fails int, range int, text binary"
FLAGGED = pa.schema(list(MOVED)[:3])


def own_fails(text: bytes, characters: int) -> int:
    """Bits of the filters that need one text only."""
    # Bytes split at the ASCII white space that bounds a word here.
    words = text.split()
    return (
        BIT["A"] * (len(words) < 100)
        | BIT["B"] * (100 * len(set(words)) < 80 * len(words))
        | BIT["C"] * (100 * (len(text) - len(text.translate(None, CAPITALS))) > 10 * characters)
        | BIT["D"] * (len(text.translate(None, SYMBOLS)) < len(text))
    )


class Node:
    """An edge's label and what follows it; ``least`` is set where a text ends."""

    __slots__ = ("label", "next", "least")

    def __init__(self, label: bytes):
        self.label, self.next, self.least = label, {}, None


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the start that ``a`` shares with ``b`` from ``at`` on."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Compressed trie of whole texts with the least number at each end."""

    def __init__(self):
        self.root = Node(b"")

    def enter(self, text: bytes, number: int) -> Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.next.get(text[at])
            if child is None:
                child = node.next[text[at]] = Node(text[at:])
            elif not text.startswith(child.label, at):
                shared = _common(child.label, text, at)
                upper = Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.next[child.label[0]] = child
                node.next[text[at]] = child = upper
            node, at = child, at + len(child.label)
        if node.least is None or number < node.least:
            node.least = number
        return node


def _first_letters(texts: DataFrame, letters: int) -> DataFrame:
    """Size and first letters of every distinct text, stored; copies count once."""
    return stage(
        texts.groupBy(F.xxhash64("text").alias("digest"))
        .agg(
            F.min(F.substring("text", 1, letters)).alias("head"),
            F.max(F.octet_length("text").cast("long") + ROW_BYTES).alias("bytes"),
            F.max(F.char_length("text")).alias("letters"),
        )
        .drop("digest"),
        "letters",
    )


def text_ranges(texts: DataFrame, part_bytes: int = PART_BYTES) -> list[bytes]:
    """Where ranges of ``(text)`` begin that hold about ``part_bytes`` each.

    One prefix per range comes to the driver: a few letters for some megabytes.
    """
    held, letters = HELD_LETTERS, FIRST_LETTERS
    level = _first_letters(texts, held)
    leaves = None
    while True:
        sums = stage(
            level.groupBy(F.substring("head", 1, letters).alias("prefix")).agg(
                F.sum("bytes").alias("bytes"), F.max("letters").alias("longest")
            ),
            "prefixes",
        )
        heavy = (F.col("bytes") > part_bytes // 2) & (F.col("longest") > letters)
        light = sums.where(~heavy).select("prefix", "bytes")
        leaves = light if leaves is None else leaves.unionByName(light)
        longer = sums.where(heavy).select(F.col("prefix").alias("_heavy"))
        if longer.isEmpty():
            break
        if letters * LONGER > held:
            held = letters * LONGER
            under = texts.join(longer, F.substring("text", 1, letters) == F.col("_heavy"), "left_semi")
            level = _first_letters(under, held)
        else:
            level = level.join(longer, F.substring("head", 1, letters) == F.col("_heavy"), "left_semi")
        letters *= LONGER
    ordered = in_order(leaves.withColumn("all", F.lit(0)), "prefix", label="leaves")
    placed = running_totals(ordered, "all", "bytes").select(
        "prefix", F.floor(F.col("_start") / part_bytes).alias("range")
    )
    starts = placed.groupBy("range").agg(F.min("prefix").alias("start")).collect()
    return [b"", *sorted(row["start"].encode() for row in starts)[1:]]


def _batches(rows: list[tuple], schema: pa.Schema, limit: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), limit):
        columns = zip(*rows[at : at + limit], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )


def flagged(docs: DataFrame, part: str = "lang", part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, part, fails)``: the bits of the filters that every document fails."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    starts = spark.sparkContext.broadcast(text_ranges(texts.select("text"), part_bytes))
    ranges = len(starts.value)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Own flags, and copies of a text met in the same block."""

        def sent(block: list[tuple]) -> Iterator[pa.RecordBatch]:
            trie, rows = Trie(), []
            ends = [None if i is None else trie.enter(text, i) for i, _, _, text in block]
            for (number, name, fails, text), end in zip(block, ends, strict=True):
                if end is None or number > end.least:
                    copy = 0 if end is None else BIT["E"]
                    place = zlib.crc32(str(number).encode()) % ranges
                    rows.append((number, name, fails | copy, place, None))
                else:
                    rows.append((number, name, fails, bisect_right(starts.value, text) - 1, text))
            return _batches(rows, MOVED)

        block, size = [], 0
        for batch in batches:
            column = batch["text"]
            for number, name, text, characters in zip(
                batch["doc_id"].to_pylist(), batch["part"].to_pylist(),
                column.cast(pa.binary()).to_pylist(), pc.utf8_length(column).to_pylist(), strict=True,
            ):
                block.append((number, name, own_fails(text, characters), text))
                size += len(text) + ROW_BYTES
                if size >= block_bytes:
                    yield from sent(block)
                    block, size = [], 0
        yield from sent(block)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies within a range of texts; rows without a text are done."""
        trie, waiting = Trie(), []
        for batch in batches:
            done = []
            for number, name, fails, text in zip(
                *(batch[c].to_pylist() for c in ("doc_id", "part", "fails", "text")), strict=True
            ):
                if text is None:
                    done.append((number, name, fails))
                else:
                    waiting.append((number, name, fails, trie.enter(text, number)))
            yield from _batches(done, FLAGGED)
        rows = [(i, name, fails | BIT["E"] * (i > end.least)) for i, name, fails, end in waiting]
        yield from _batches(rows, FLAGGED)

    moved = texts.select("doc_id", "part", "text").mapInArrow(near, MOVED_DDL)
    return moved.repartitionById(ranges, F.col("range")).mapInArrow(far, "doc_id long, part string, fails int")


def steps_of_all_orders() -> list[tuple[str, int, str, int, int]]:
    """``(order, step, filter, its bit, bits of those before)`` for all orders of the filters."""
    rows = []
    for order in map("".join, itertools.permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            rows.append((order, step, name, BIT[name], before))
            before |= BIT[name]
    return rows


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of ``(part, fails, n, good, toxic)``, a row per part, order and step."""
    steps = F.array(
        *(
            F.struct(*(F.lit(v).alias(k) for k, v in zip(("filter_order", "step", "filter", "bit", "before"), row, strict=True)))
            for row in steps_of_all_orders()
        )
    )
    rows = counts.select("*", F.inline(steps))
    fails, bit, before = F.col("fails"), F.col("bit"), F.col("before")
    hit, gone = fails.bitwiseAND(bit) != 0, fails.bitwiseAND(before) != 0

    def total(condition, column="n"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    audit = rows.groupBy("part", "filter_order", "step", "filter").agg(
        total(~hit & ~gone).alias("kept"),
        total(hit & ~gone).alias("removed"),
        total(hit & gone).alias("redundant"),
        total(fails == bit).alias("unique_fails"),
        total(hit & ~gone, "good").alias("good_lost"),
        total(hit & ~gone, "toxic").alias("toxic_lost"),
    )
    audit = stage(audit, "audit")
    shares = audit.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(
        F.sum("removed").alias("shapley")
    )
    same = (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter"))
    return audit.join(shares, same).drop("_part", "_filter", "filter")


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """What filters remove from every part, in all orders of the filters.

    Per part, order and step: documents kept after the step, removed by it, failing its
    filter but removed before, failing its filter only, good and toxic ones removed, and
    what its filter removes over all orders.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    rows = flagged(docs, part).join(marks, F.col("doc_id") == F.col("_doc"), "left")
    counts = rows.groupBy("part", "fails").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    return interactions(stage(counts, "fails"))
