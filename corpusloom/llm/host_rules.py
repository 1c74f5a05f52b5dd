"""Quality rules judged by host.

Every text is measured whole, and four rules look at the measures: too few words,
repeated passages, many symbols, repeated lines. The first two also reject a document by
itself. Failures are added up by host. A host's rate is shrunk towards that of all hosts by an
empirical beta prior: how far rates of hosts differ beyond what chance does gives the
prior's weight, in documents (method of moments). So a host with few documents is
judged by all others, and one with many by its own. Where a shrunk rate is over the limit
the host is rejected, and the verdict goes back to all its documents.

Only measures are shuffled, sums by host are made before the shuffle, and what is joined
back are the rejected hosts alone.

Odd rows: a null text has no words and fails the first rule; null hosts are one host;
repeated rows count each; a very long text is measured whole; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

WINDOW = 5
FEWEST_WORDS = 10
HOST_LIMIT = 0.5
# The contract's characters.
SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
STRUCT = pa.struct([(m, pa.int64()) for m in MEASURES])
RULES = {
    "short": "n_words < 10",
    "repeated": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE = ("short", "repeated")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that the list holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "uint64", len(words))
    mixed = np.zeros(n, "uint64")
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    alike = np.flatnonzero(mixed[order[1:]] == mixed[order[:-1]])
    if not len(alike):
        return 0
    first, second = order[alike], order[alike + 1]
    windows = np.lib.stride_tricks.sliding_window_view(ids, window)
    if not (windows[first] == windows[second]).all():
        # Different windows with one code: compare the windows themselves.
        _, which, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[which.ravel()] > 1)
    else:
        starts = np.union1d(first, second)
    edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(
        starts + window, minlength=len(words) + 1
    )
    return int((np.cumsum(edges) > 0).sum())


def measured_text(text: bytes, characters: int) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        characters - (len(text) - len(text.translate(None, SPACES))),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def measured(docs: DataFrame) -> DataFrame:
    """The rows of ``docs (doc_id, host, text)`` with measures and failed rules for the text."""

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def measures(texts: pa.Array) -> pa.Array:
        whole = pc.fill_null(texts, "")
        rows = [
            measured_text(t, n)
            for t, n in zip(whole.cast(pa.binary()).to_pylist(), pc.utf8_length(whole).to_pylist(), strict=True)
        ]
        columns = zip(*rows) if rows else [[]] * len(MEASURES)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(STRUCT))

    rows = docs.select("doc_id", "host", measures("text").alias("m")).select("doc_id", "host", "m.*")
    fails = [F.expr(rule).alias(name) for name, rule in RULES.items()]
    return stage(rows.select("*", *fails), "measures")


@dataclass(frozen=True)
class Beta:
    """A prior with ``weight`` documents' worth of evidence for ``mean``."""

    mean: float
    weight: float

    def shrunk(self, failed: Column, docs: Column) -> Column:
        if not np.isfinite(self.weight):
            return F.lit(self.mean)
        return (failed + self.mean * self.weight) / (docs + self.weight)


def beta_from_sums(hosts: int, docs: int, failed: int, squares: float, spread: float) -> Beta:
    """The prior from sums over hosts: n, f, n squared, and f squared over n.

    The share of variance between hosts beyond chance is estimated by moments; none leaves a prior of endless weight.
    """
    if docs == 0:
        return Beta(0.0, np.inf)
    mean = failed / docs
    chance = mean * (1 - mean)
    between = spread - failed * mean - chance * (hosts - 1)
    room = chance * (docs - squares / docs - (hosts - 1))
    if between <= 0 or room <= 0:
        return Beta(mean, np.inf)
    return Beta(mean, max(0.0, room / between - 1))


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Every host with its documents, failures and shrunk rates by rule, and ``rejected``."""
    hosts = stage(
        rows.groupBy("host").agg(
            F.count("*").alias("docs"), *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES)
        ),
        "hosts",
    )
    sums = [F.count("*").alias("hosts"), F.sum("docs").alias("docs"), F.sum(F.col("docs").cast("double") ** 2).alias("squares")]
    for rule in RULES:
        sums += [F.sum(rule).alias(rule), F.sum(F.col(rule).cast("double") ** 2 / F.col("docs")).alias(f"{rule}_spread")]
    all_of = hosts.agg(*sums).first()
    if not all_of["hosts"]:
        priors = {rule: Beta(0.0, np.inf) for rule in RULES}
    else:
        priors = {
            rule: beta_from_sums(
                all_of["hosts"], all_of["docs"], all_of[rule], all_of["squares"], all_of[f"{rule}_spread"]
            )
            for rule in RULES
        }
    rates = {rule: prior.shrunk(F.col(rule), F.col("docs")) for rule, prior in priors.items()}
    return hosts.select(
        "*",
        *(rate.alias(f"{rule}_rate") for rule, rate in rates.items()),
        (F.greatest(*rates.values()) > limit).alias("rejected"),
    )


def judged(docs: DataFrame, host: Column, limit: float = HOST_LIMIT) -> DataFrame:
    """Measures, ``base_failed``, ``host_rejected`` and ``kept`` for every row of ``docs``."""
    rows = measured(docs.select("doc_id", host.alias("host"), "text"))
    rejected = host_verdicts(rows, limit).where("rejected").select(
        F.col("host").alias("_host"), F.lit(True).alias("_rejected")
    )
    marked = rows.join(rejected, F.col("host").eqNullSafe(F.col("_host")), "left")
    failed = F.greatest(*(F.col(r) for r in BASE))
    of_host = F.coalesce("_rejected", F.lit(False))
    return marked.select(
        "doc_id",
        "host",
        *MEASURES,
        failed.alias("base_failed"),
        of_host.alias("host_rejected"),
        (~failed & ~of_host).alias("kept"),
    )
