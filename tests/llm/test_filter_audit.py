"""The filter audit against plain Python, with small ranges and blocks, and on odd rows."""

import itertools
import random
import re

import pytest

from corpusloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fails(rows):
    """Letters that every (doc_id, text) fails, as a multiset of (doc_id, letters)."""
    least = {}
    for i, text in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text in rows:
        text = text or ""
        words = WORD.findall(text)
        failed = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        out.append((i, "".join(k for k, v in failed.items() if v)))
    return sorted(out, key=str)


def letters(frame):
    return sorted(
        ((r.doc_id, "".join(k for k in "ABCDE" if r.fails & filter_audit.BIT[k])) for r in frame.collect()), key=str
    )


def near_copies():
    rng = random.Random(3)
    shared = "All of this stands at the head of many pages. " * 40
    texts = [shared + f"Page {rng.randrange(400)}" for _ in range(600)]
    texts += ["the very same text"] * 300 + [f"{i}é own {'#' * (i % 2)} TEXT" for i in range(100)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("part_bytes", "block_bytes"), [(4000, 3000), (1 << 25, 1 << 24)])
def test_copies_are_found_in_any_range(spark, part_bytes, block_bytes):
    rows = near_copies()
    docs = spark.createDataFrame([(i, "en", t) for i, t in rows], "doc_id long, lang string, text string")
    docs = docs.repartition(7)
    found = filter_audit.flagged(docs, part_bytes=part_bytes, block_bytes=block_bytes)
    assert letters(found) == brute_fails(rows)


def test_ranges_are_even_under_a_long_shared_head(spark):
    texts = [t for _, t in near_copies()]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    starts = filter_audit.text_ranges(frame, part_bytes=20_000)
    assert starts == sorted(set(starts)) and len(starts) > 10
    held = dict.fromkeys(range(len(starts)), 0)
    for t in set(texts):
        held[sum(s <= t.encode() for s in starts) - 1] += len(t.encode()) + filter_audit.ROW_BYTES
    assert max(held.values()) <= 35_000


def test_trie_equals_a_dictionary():
    rng = random.Random(4)
    trie, least, ends = filter_audit.Trie(), {}, {}
    for number in rng.sample(range(5000), 3000):
        text = bytes(rng.choices(b"ab", k=rng.randrange(9)))
        least[text] = min(number, least.get(text, number))
        ends[text] = trie.enter(text, number)
    assert {t: end.least for t, end in ends.items()} == least


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_flags(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert letters(filter_audit.flagged(docs, block_bytes=2000)) == brute_fails(rows)


def test_audit_of_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (4, None, 1), (5, 1, None), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    good, toxic = {1, 5}, {1, 4}
    docs = [(r.doc_id, r.lang or "", r.text) for r in odd.collect()]
    fails = dict.fromkeys(range(len(docs)))
    for k, (i, _, text) in enumerate(docs):
        fails[k] = dict(brute_fails([(d, t) for d, _, t in docs]))[i]
    want = {}
    for part in {p for _, p, _ in docs}:
        rows = [k for k, d in enumerate(docs) if d[1] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                hit = [k for k in left if name in fails[k]]
                left = [k for k in left if name not in fails[k]]
                failing = [k for k in rows if name in fails[k]]
                shapley[name] += len(hit)
                want[part, "".join(order), step] = [
                    len(left), len(hit), len(failing) - len(hit), sum(fails[k] == name for k in rows),
                    sum(docs[k][0] in good for k in hit), sum(docs[k][0] in toxic for k in hit), name,
                ]
        for (p, _, _), row in want.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    found = {tuple(r)[:3]: list(tuple(r)[3:]) for r in filter_audit.audit_filters(odd, labels).collect()}
    assert found == want


def test_empty_table(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(empty, labels).count() == 0
