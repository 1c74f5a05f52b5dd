"""Structure repair of conversations by the auction algorithm for shortest paths.

A repaired conversation has role initials ``(s?(ua)+)?``. Its rows are kept (K, cost 0),
given another role (R, 2) or deleted (D, 3, the only edit for blank and repeated rows);
rows without text may be inserted anywhere (I, 2); a truncated row that stays costs 1.

The edits are paths through a lattice of (rows read, state), the states being: nothing
written, after ``s``, after ``u``, after ``a``. Every node has an integer price. The
auction extends its path along the arc that is cheapest by cost plus price of its head,
and where the price of the last node is below that, raises it and steps back. Prices stay
feasible throughout, so once a node is settled its price is its exact distance, and all
arcs of its cheapest paths are tight. Tight arcs are followed in the order of their
letters, which gives the ASCII-least of the cheapest edit strings.

A long conversation is cut into windows of rows, settled from the last one back: the four
prices at the head of a window are the targets of the one before. So work grows with the
number of rows, not with its square.

Texts stay out of this. Rows are ordered by ranges of all sort keys, so a conversation
with a third of all rows spans many tasks; every row becomes one letter, and only the
letters of a conversation, as many bytes as its result row holds, come together. Last, the
rows stream through a task in order, where the edits are applied; a digest is taken as
rows pass, and none is gathered.

Odd rows: a null conversation number is a conversation of its own; a null turn sorts first;
null roles and texts are one space; rows with equal turns are in order of role and text;
repeated rows are repeated messages; a very long text streams as any other; a conversation
without rows has zeros, no edits and the digest of nothing; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.ordering import in_order
from corpusloom.session import stage

# What counts as white space, what ends a sentence, and the costs.
BLANK = r"\x20\x09-\x0D"
ENDINGS = "[.!?]"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

WINDOW = 32
PIECE_ROWS = 4096
CACHED_ROWS = 48
CACHED = 50_000
FAULTS = ("none", "blank", "duplicate", "truncated")
INITIALS = ("s", "u", "a")
FIRST_CODE = ord("A")
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# Distances from the end of a conversation, where only inserts are left.
AT_END = (0, 2 * INSERT, INSERT, 0)


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults put in by a checksum of the row's key.

    The checksum modulo 20 drops the row (0), empties its text (1), takes the ends of
    its sentences (2), repeats it (3) or makes it the user's (4). Nulls are one space.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault")
    ).where("fault <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", ENDINGS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """The stored rows in order of conversation, turn, role and text, nulls first."""
    plain = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    return in_order(plain, "conv_id", "turn", "role", "text", label="turns")


def row_codes(ordered: DataFrame) -> DataFrame:
    """``(conv_id, turn, code, _part, _pos)``: one letter for initial and first fault of a row."""
    narrow = ordered.select(
        "conv_id",
        "turn",
        "role",
        "_part",
        "_pos",
        F.md5("text").alias("digest"),
        (~F.col("text").rlike(f"[^{BLANK}]")).alias("blank"),
        (~F.col("text").rlike(rf"{ENDINGS}[{BLANK}]*\z")).alias("truncated"),
    )
    # Only messages that a conversation repeats meet their rows again.
    again = (
        narrow.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("_part", "_pos")).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("role") == F.col("_role"))
        & (F.col("digest") == F.col("_digest"))
    )
    later = F.coalesce(F.struct("_part", "_pos") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(later, 2).when(F.col("truncated"), 3).otherwise(0)
    initial = F.array_position(F.array(*map(F.lit, INITIALS)), F.substring("role", 1, 1))
    code = F.char(F.lit(FIRST_CODE) + 4 * initial.cast("int") + fault)
    return narrow.join(again, same, "left").select("conv_id", "turn", code.alias("code"), "_part", "_pos")


def _arcs(code: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """``(letter, cost, rows read, next state)`` from a state before a row, in order of letters."""
    initial, fault = divmod(ord(code) - FIRST_CODE, 4)
    due = ASSISTANT if state == USER else USER
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, due)]
    if FAULTS[fault] not in ("blank", "duplicate"):
        more = TRUNCATED if FAULTS[fault] == "truncated" else 0
        # Initials are numbered as the states they lead to; 0 is any other role.
        if initial == due or (initial == SYSTEM and state == NOTHING):
            arcs.append(("K", more, 1, initial))
        arcs.append(("R", REROLE + more, 1, due))
    return tuple(arcs)


# Arcs by letter of the row and state.
ARCS = {chr(FIRST_CODE + n): [_arcs(chr(FIRST_CODE + n), q) for q in range(4)] for n in range(16)}


class Auction:
    """Prices of the lattice over one window of rows."""

    def __init__(self, codes: str, beyond: tuple[int, ...]):
        self.codes = codes
        self.end = 4 * len(codes)
        # Equal prices below all targets are feasible: no arc has a negative cost.
        self.price = [min(beyond)] * self.end + list(beyond)

    def settle(self, origin: int) -> int:
        """Raise prices until that of ``origin``, a row and a state, is its distance."""
        price, codes, end = self.price, self.codes, self.end
        path = [origin]
        while path[-1] < end:
            node = path[-1]
            least, head = None, 0
            for _, cost, read, state in ARCS[codes[node >> 2]][node & 3]:
                to = ((node >> 2) + read) * 4 + state
                if least is None or cost + price[to] < least:
                    least, head = cost + price[to], to
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
        return price[origin]

    def traced(self, state: int) -> tuple[str, int]:
        """The least letters of a cheapest path from the window's head, and its last state."""
        letters, node = [], state
        self.settle(node)
        while node < self.end:
            for letter, cost, read, state in ARCS[self.codes[node >> 2]][node & 3]:
                to = ((node >> 2) + read) * 4 + state
                # Prices bound distances from below, so only a tight arc needs its head settled.
                if cost + self.price[to] > self.price[node]:
                    continue
                if to >= self.end or cost + self.settle(to) == self.price[node]:
                    letters.append(letter)
                    node = to
                    break
        return "".join(letters), node - self.end


AT_END_LETTERS = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def cheapest_edits(codes: str, window: int = WINDOW) -> tuple[int, str]:
    """Cost and ASCII-least letters of the cheapest edits of a conversation."""
    starts = range(0, len(codes), window)
    beyond = [AT_END]
    for at in reversed(starts):
        lattice = Auction(codes[at : at + window], beyond[-1])
        beyond.append(tuple(lattice.settle(state) for state in range(4)))
    cost, state, letters = beyond.pop()[NOTHING], NOTHING, []
    for at in starts:
        traced, state = Auction(codes[at : at + window], beyond.pop()).traced(state)
        letters.append(traced)
    return cost, "".join(letters) + AT_END_LETTERS[state]


LEGAL = {"su", "ua", "au"}
REPORT = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
    ]
)
REPORT_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _gaps(pieces: list[dict]) -> int:
    known = [p for p in pieces if p["low"] is not None]
    if not known:
        return 0
    # Turns ascend from piece to piece, so only neighbours can share one.
    shared = sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    turns = sum(p["turns"] for p in known) - shared
    return known[-1]["high"] - known[0]["low"] + 1 - turns


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[int, str]] = {}

    def edits(codes: str) -> tuple[int, str]:
        """As ``cheapest_edits``; short conversations often have the same letters."""
        if len(codes) > CACHED_ROWS:
            return cheapest_edits(codes)
        if codes not in known:
            if len(known) >= CACHED:
                known.clear()
            known[codes] = cheapest_edits(codes)
        return known[codes]

    for batch in batches:
        out = []
        for conv_id, pieces in zip(batch["conv_id"].to_pylist(), batch["pieces"].to_pylist(), strict=True):
            codes = "".join(p["codes"] for p in pieces)
            numbers = [ord(c) - FIRST_CODE for c in codes]
            initials = "".join(("?", *INITIALS)[n >> 2] for n in numbers)
            faults = [n & 3 for n in numbers]
            cost, audit = edits(codes)
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            counts = [faults.count(f) for f in (1, 2, 3)]
            out.append((conv_id, _gaps(pieces), *counts, illegal, cost, audit))
        columns = zip(*out) if out else [[]] * len(REPORT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, REPORT, strict=True)], schema=REPORT
        )


def structure_reports(ordered: DataFrame) -> DataFrame:
    """Faults, cheapest cost and edits ``(conv_id, gaps, ..., cost, audit)`` of every conversation.

    Letters are joined in pieces of bounded rows first, then by conversation.
    """
    piece = F.shiftright("_pos", PIECE_ROWS.bit_length() - 1).alias("_piece")
    letters = F.array_sort(F.collect_list(F.struct("_pos", "code")))
    pieces = row_codes(ordered).groupBy("conv_id", "_part", piece).agg(
        F.array_join(F.transform(letters, lambda r: r["code"]), "").alias("codes"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"),
    )
    whole = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_part", "_piece", "codes", "low", "high", "turns"))).alias("pieces")
    )
    return whole.mapInArrow(_reports, REPORT_DDL)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``("open", report)``, then ``("row", edit, role, text)`` for all that stays, per conversation.

    ``rows`` has a report row ahead of the rows of each conversation.
    """
    audit, at, last = "", 0, ""

    def inserted(until: str):
        nonlocal at, last
        while audit[at : at + 1] == "I" and until:
            role = "assistant" if last == "u" else "user"
            at, last = at + 1, role[0]
            yield "row", "I", role, ""

    for place, report, role, text in rows:
        if place < 0:
            yield from inserted("the end")
            audit, at, last = report["audit"], 0, ""
            yield "open", report
            continue
        yield from inserted("the row")
        edit, at = audit[at], at + 1
        if edit != "D":
            if edit == "R":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            yield "row", edit, role, text
    yield from inserted("the end")


def _streamed(ordered: DataFrame, reports: DataFrame) -> DataFrame:
    """Rows behind the report of their conversation, every conversation in one task."""
    head = [F.col(n) for n in REPORT.names[1:]]
    reported = reports.select(
        "conv_id", F.struct(*head).alias("report"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(-1).cast("long").alias("_part"), F.lit(0).cast("long").alias("_pos"),
    )
    rows = ordered.select(
        "conv_id", F.lit(None).cast(reported.schema["report"].dataType).alias("report"), "role", "text", "_part", "_pos"
    )
    columns = ["conv_id", "report", "role", "text", "_part", "_pos"]
    return (
        reported.unionByName(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "_part", "_pos")
        .select(*columns)
    )


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    def rows():
        for batch in batches:
            ids = batch["conv_id"].to_pylist()
            for i, place, report, role, text in zip(
                ids, batch["_part"].to_pylist(), batch["report"].to_pylist(),
                batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True,
            ):
                yield place, report and {"conv_id": i, **report}, role, text

    return _edited(rows())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield batch()
            held = []
    if held:
        yield batch()


def reports_of_all(rows: DataFrame, ordered: DataFrame) -> DataFrame:
    """The stored report of every conversation in ``rows``, zeros where no row is left."""
    named = rows.select(F.col("conv_id").alias("_conv")).distinct()
    found = structure_reports(ordered)
    numbers = [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in REPORT.names[1:-1]]
    return stage(
        named.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
            F.col("_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit")
        ),
        "reports",
    )


TURN = pa.schema(
    [("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``(conv_id, seq, edit, role, text)``: the repaired conversations, row by row.

    A conversation whose cheapest repair deletes everything has no rows.
    """
    ordered = ordered_rows(rows)

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbered():
            conv_id, seq = None, 0
            for event in _events(batches):
                if event[0] == "open":
                    conv_id, seq = event[1]["conv_id"], 0
                else:
                    yield conv_id, seq, *event[1:]
                    seq += 1

        return _in_batches(numbered(), TURN)

    streamed = _streamed(ordered, reports_of_all(rows, ordered))
    return streamed.mapInArrow(repaired, "conv_id long, seq long, edit string, role string, text string")


def repair_reports(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """The report and ``repaired_sha256`` of every conversation of ``original``.

    ``damaged`` holds the rows to repair. The digest is that of the lines ``role:text``.
    """
    ordered = ordered_rows(damaged)
    schema = REPORT.append(pa.field("repaired_sha256", pa.string()))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished():
            report, digest, lines = None, None, 0
            for event in _events(batches):
                if event[0] == "open":
                    if report is not None:
                        yield *(report[n] for n in REPORT.names), digest.hexdigest()
                    report, digest, lines = event[1], hashlib.sha256(), 0
                else:
                    digest.update(("\n" * (lines > 0) + event[2] + ":" + event[3]).encode())
                    lines += 1
            if report is not None:
                yield *(report[n] for n in REPORT.names), digest.hexdigest()

        return _in_batches(finished(), schema)

    streamed = _streamed(ordered, reports_of_all(original, ordered))
    return streamed.mapInArrow(digested, REPORT_DDL + ", repaired_sha256 string")
