"""Host rules against plain Python, on known rates and on odd rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    places = collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines, seen, again = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), len(lines),
    )


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_measures(request, name):
    docs = request.getfixturevalue(name)
    found = host_rules.judged(docs, F.col("source")).collect()
    want = [(r.doc_id, *brute_measures(r.text)) for r in docs.collect()]
    assert sorted(((r.doc_id, *(r[m] for m in host_rules.MEASURES)) for r in found), key=str) == sorted(want, key=str)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.host_rejected)


def test_repeats_of_random_words():
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(60))]
        assert host_rules.repeated_words(words) == brute_measures(b" ".join(words).decode())[4]


def test_windows_of_one_code_are_told_apart(monkeypatch):
    class Flat(np.ndarray):
        """Stands in for mixing that gives every window the same code."""

    plain = np.zeros
    monkeypatch.setattr(host_rules.np, "zeros", lambda n, t: plain(n, t).view(Flat))
    monkeypatch.setattr(Flat, "__mul__", lambda self, other: self)
    monkeypatch.setattr(Flat, "__add__", lambda self, other: self)
    words = b"a b c d e f g a b c d e x y".split()
    assert host_rules.repeated_words(words) == 10


def test_a_host_of_failures_goes_with_its_clean_pages(spark):
    rng = random.Random(2)
    clean = lambda: " ".join(str(rng.random()) for _ in range(30))
    rows = []
    for host in range(40):
        rows += [(len(rows) + i, f"h{host}", clean() if i % 20 else "short") for i in range(100)]
    rows += [(len(rows) + i, "bad", clean() if i % 10 == 0 else "short") for i in range(200)]
    # One failure of one document says little: the prior holds its rate down.
    rows += [(len(rows), "new", "short"), (len(rows) + 1, None, clean())]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = host_rules.judged(docs, F.col("source")).collect()
    assert {r.host for r in found if r.host_rejected} == {"bad"}
    kept = {r.doc_id for r in found if r.kept}
    assert kept == {i for i, host, text in rows if host != "bad" and text != "short"}


def test_prior_finds_the_rates_it_was_drawn_from():
    rng = np.random.default_rng(6)
    docs = rng.integers(5, 400, 4000)
    failed = rng.binomial(docs, rng.beta(3, 17, 4000))
    prior = host_rules.beta_from_sums(
        len(docs), int(docs.sum()), int(failed.sum()), float((docs**2.0).sum()), float((failed**2 / docs).sum())
    )
    assert abs(prior.mean - 0.15) < 0.01 and 17 < prior.weight < 23


def test_equal_hosts_share_one_rate(spark):
    rows = [(i, f"h{i % 3}", "short" if i < 6 else "one two three four five six seven eight nine ten") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    verdicts = host_rules.host_verdicts(host_rules.measured(docs.select("doc_id", F.col("source").alias("host"), "text")))
    assert {r.short_rate for r in verdicts.collect()} == {0.2}


def test_empty_table(empty):
    assert host_rules.judged(empty, F.col("source")).count() == 0
