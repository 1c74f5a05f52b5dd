"""Conversation repair against an exhaustive dynamic programme, and on odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from corpusloom.llm import conversation_repair as repair

WORDLIKE = re.compile(r"[^\x20\x09-\x0D]")


def brute_edits(rows):
    """Least (cost, letters) over all edits; rows are (role, fault). Works from the end back."""
    best = {0: (0, ""), 3: (0, "")}
    best = relaxed(best)
    for role, fault in reversed(rows):
        now = {}
        for q in range(4):
            options = []
            if q in best:
                options.append((3 + best[q][0], "D" + best[q][1]))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                to = {"s": 1, "u": 2, "a": 3}.get(role[:1])
                fits = {1: q == 0, 2: q != 2, 3: q == 2}.get(to, False)
                if fits and to in best:
                    options.append((extra + best[to][0], "K" + best[to][1]))
                for name in (2, 3):
                    if (name == 3) == (q == 2) and name in best:
                        options.append((2 + extra + best[name][0], "R" + best[name][1]))
            if options:
                now[q] = min(options)
        best = relaxed(now)
    return best[0]


def relaxed(best):
    """Adds inserts until nothing gets better."""
    best = dict(best)
    changed = True
    while changed:
        changed = False
        for q in range(4):
            to = 3 if q == 2 else 2
            if to in best:
                new = (2 + best[to][0], "I" + best[to][1])
                if q not in best or new < best[q]:
                    best[q], changed = new, True
    return best


def brute_damage(table):
    out = []
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def brute(table):
    damaged, result = brute_damage(table), {}
    for conv in {r[0] for r in table}:
        rows = [r[1:] for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = WORDLIKE.findall(text)
            if not solid:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            elif solid[-1] not in ".!?":
                faults.append("truncated")
            else:
                faults.append("none")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = brute_edits([(r, f) for (_, r, _), f in zip(rows, faults)])
        lines, at = [], 0
        for letter in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if letter == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                lines.append(f"{due if letter == 'R' else role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        result[conv] = (
            gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


def found(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("window", [1, 3, 32])
def test_edits_equal_the_dynamic_programme(window):
    rng = random.Random(window)
    for _ in range(400):
        codes = [rng.choice("ABCDEFGHIJKLMNOP" if rng.random() < 0.5 else "EIMI") for _ in range(rng.randrange(14))]
        rows = [
            (("x", "s", "u", "a")[(ord(c) - 65) // 4], repair.FAULTS[(ord(c) - 65) % 4]) for c in codes
        ]
        assert repair.cheapest_edits("".join(codes), window) == brute_edits(rows)


def test_a_long_conversation_takes_linear_work():
    rng = random.Random(5)
    codes = "".join(rng.choice("IMIMIMIMABCDEFGHIJKLMNOP") for _ in range(4000))
    rows = [(("x", "s", "u", "a")[(ord(c) - 65) // 4], repair.FAULTS[(ord(c) - 65) % 4]) for c in codes]
    assert repair.cheapest_edits(codes) == brute_edits(rows)


def test_query_equals_brute_force(spark):
    from corpusloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = QUERIES["op11_conversation_repair"](spark, folder)
    assert found(rows) == brute(table)


ODD_TURNS = [
    (None, None, None, None),
    (None, 3, "user", "So?"),
    (1, None, "user", "Hm."),
    (1, 2, "user", "Hm."),
    (1, 2, "assistant", "Hm."),
    (1, 2, "assistant", "Hm."),
    (1, 9, "", "no role."),
    (2, 0, "system", "Be kind."),
    (3, 5, "tool", "42"),
    (4, 0, "user", "Well? " * 20_000),
    (4, 1, "assistant", " "),
    *[(5, t, "user" if t % 3 else "assistant", f"{t}." if t % 7 else "again!") for t in range(120)],
    *[(c, 0, "user", "x") for c in range(10, 60)],
]


def test_odd_rows(spark, monkeypatch):
    # Small pieces, so that conversations span several.
    monkeypatch.setattr(repair, "PIECE_ROWS", 4)
    schema = "conv_id long, turn long, role string, text string, code int, _part string, report date"
    table = spark.createDataFrame([(*r, 1, "x", None) for r in ODD_TURNS], schema)
    want = brute(ODD_TURNS)
    assert found(repair.repair_reports(table, repair.damage(table))) == want
    empty = table.where("false")
    assert repair.repair_reports(empty, repair.damage(empty)).count() == 0
    # A conversation that loses all its rows.
    gone = [c for c in range(10, 60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(want[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_repaired_turns_alternate(spark):
    table = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string")
    by_conv = {}
    for r in repair.repaired_turns(repair.damage(table)).collect():
        by_conv.setdefault(r.conv_id, []).append((r.seq, r.role, r.text))
    for conv, rows in by_conv.items():
        rows.sort()
        assert re.fullmatch("s?(ua)+", "".join(role[0] for _, role, _ in rows))
        lines = "\n".join(f"{role}:{text}" for _, role, text in rows)
        assert hashlib.sha256(lines.encode()).hexdigest() == brute(ODD_TURNS)[conv][-1]
