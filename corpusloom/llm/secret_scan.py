"""Secrets in whole texts: fixed rules, and a character network over every candidate.

Every run of 12 or more characters that credentials are made of is a candidate. A
small convolutional network in numpy reads the characters of the candidate and of its
surroundings: embedding, one convolution, the maximum of each filter inside the
candidate and around it, one logistic unit. A longer candidate is read through a window
that slides over all of it; its highest probability counts. What the rules leave of a run
they found something in is a candidate too.

It is trained on the distinct labelled findings of all documents. These are dealt out by hash
in shards of bounded size; in every round each shard trains from the same weights inside its
task, and the weights are averaged by the shards' sizes. The labels are the
rules' own, so part of the training windows lose what the rules go by: a secret is shown in the
surroundings of an ordinary candidate, or with other first characters. Calibration uses
findings held out, as they stand, and the limit is the highest one that keeps the wanted recall
on all of them; the share of other candidates over it is kept as ``alarms``. Findings of the rules
always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import arrow_batch, stage

SHARD = 50_000
# A shard goes on for so many windows, within the least and the largest number of passes.
SEEN, PASSES = 72_000, (2, 6)
BUCKETS = 1_024
TEXTS_AT_ONCE = 500
RECALL = 0.98
BEFORE, INSIDE, AFTER = 20, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
STEP = INSIDE // 2
SHORTEST = 12
TOKEN_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ALPHABET, CODES, FILTERS, SPAN = 98, 8, 24, 5
SEED = 7
KINDS = ("assign", "access", "hex", "network")


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# Rules for findings.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
CANDIDATE = re.compile("[A-Za-z0-9+/_.=-]{12,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[int, int, int]


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def base_findings(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """Findings of the rules as ``(start, kind, end)`` in their order.

    Long enough access keys and digit runs lie inside candidates, so only those are
    searched; assignments are searched where a keyword occurs at all.
    """
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end()))
    for start, end in runs:
        for kind, rule in ((1, ACCESS), (2, HEX)):
            if end - start < LEAST[KINDS[kind]]:
                continue
            for m in rule.finditer(text, start, end):
                if m.end() - m.start() >= LEAST[KINDS[kind]]:
                    found.append((m.start(), kind, m.end()))
    return sorted(found)


def uncovered(runs: list[tuple[int, int]], base: list[Span]) -> list[tuple[int, int]]:
    """What findings leave of the runs, where it is long enough for a candidate."""
    if not base:
        return runs
    out = []
    for start, end in runs:
        at = start
        for s, _, e in base:
            if s < end and e > at:
                if s - at >= SHORTEST:
                    out.append((at, s))
                at = max(at, e)
        if end - at >= SHORTEST:
            out.append((at, end))
    return out


def windows_of(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Windows over a whole candidate, with the part of it that each shows inside."""
    places = range(start, max(start + 1, end - INSIDE + STEP), STEP)
    return [(window(text, at, min(end, at + INSIDE)), at, min(end, at + INSIDE)) for at in places]


def window(text: str, start: int, end: int) -> str:
    """At most ``INSIDE`` characters with what stands before and after them, in fixed width."""
    body = text[start:end]
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    return before + body.ljust(INSIDE, "\0") + text[end : end + AFTER].ljust(AFTER, "\0")


def codes(windows: list[str]) -> np.ndarray:
    """Character codes: printable ASCII, one code for blanks outside, one for all others."""
    raw = np.frombuffer("".join(windows).encode("utf-32-le"), "uint32").reshape(-1, WIDTH)
    own = raw.astype("int64") - 30
    return np.where(raw == 0, 0, np.where((own >= 2) & (own < ALPHABET), own, 1))


def _shapes() -> dict[str, tuple[int, ...]]:
    return {
        "embed": (ALPHABET, CODES),
        "filters": (SPAN * CODES, FILTERS),
        "bias": (FILTERS,),
        "out": (2 * FILTERS,),
        "level": (1,),
    }


@dataclass
class CharNetwork:
    """Weights, calibration and limit; without training it finds nothing."""

    weights: dict[str, np.ndarray] | None = None
    slope: float = 1.0
    shift: float = 0.0
    limit: float = 1.1
    alarms: float = 0.0

    def forward(self, x: np.ndarray, keep: bool = False):
        w = self.weights
        embedded = w["embed"][x]
        places = WIDTH - SPAN + 1
        view = np.lib.stride_tricks.sliding_window_view(embedded, SPAN, axis=1)
        unfolded = view.transpose(0, 1, 3, 2).reshape(len(x), places, SPAN * CODES)
        hidden = np.maximum(unfolded @ w["filters"] + w["bias"], 0)
        inner = slice(BEFORE - SPAN + 1, BEFORE + INSIDE)
        outer = slice(0, BEFORE)
        top = [hidden[:, inner].argmax(axis=1) + inner.start, hidden[:, outer].argmax(axis=1)]
        rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        pooled = np.concatenate([hidden[rows, t, cols] for t in top], axis=1)
        score = pooled @ w["out"] + w["level"][0]
        return (score, pooled, top, unfolded) if keep else score

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i : i + 256]) for i in range(0, len(x), 256)])

    def calibrated(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.shift, -50, 50)))

    def probability(self, windows: list[str]) -> np.ndarray:
        if self.weights is None or not windows:
            return np.zeros(len(windows))
        scores = [self.forward(codes(windows[i : i + 256])) for i in range(0, len(windows), 256)]
        return self.calibrated(np.concatenate(scores))


def _first_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    return {
        k: (rng.normal(0, 0.15, s) if len(s) == 2 or k == "out" else np.zeros(s)).astype("float32")
        for k, s in _shapes().items()
    }


def _rarity(plain: float, secrets: float) -> float:
    """What a secret costs, as a multiple of other candidates."""
    return min(max(1.0, plain / max(1.0, secrets)), 20.0)


def _fit(
    net: CharNetwork, x: np.ndarray, y: np.ndarray, own: np.ndarray, rare: float, passes: int, rng: np.random.Generator
) -> None:
    """Adam over the rows ``own`` in so many passes; changes the weights of the network."""
    cost = np.where(y > 0, rare, 1.0).astype("float32")
    one = {k: np.zeros_like(v) for k, v in net.weights.items()}
    two = {k: np.zeros_like(v) for k, v in net.weights.items()}
    t = 0
    for _ in range(passes):
        rng.shuffle(own)
        for at in range(0, len(own), 64):
            b = own[at : at + 64]
            score, pooled, top, unfolded = net.forward(x[b], keep=True)
            off = ((1 / (1 + np.exp(-score)) - y[b]) * cost[b] / len(b)).astype("float32")
            w = net.weights
            by_pool = off[:, None] * w["out"][None, :] * (pooled > 0)
            grad = {"out": pooled.T @ off, "level": np.array([off.sum()], "float32")}
            grad["bias"] = by_pool[:, :FILTERS].sum(axis=0) + by_pool[:, FILTERS:].sum(axis=0)
            grad["filters"] = np.zeros_like(w["filters"])
            grad["embed"] = np.zeros_like(w["embed"])
            rows = np.arange(len(b))[:, None]
            for places, part in zip(top, (by_pool[:, :FILTERS], by_pool[:, FILTERS:]), strict=True):
                seen = unfolded[rows, places]
                grad["filters"] += np.einsum("bfc,bf->cf", seen, part)
                back = part[:, :, None] * w["filters"].T[None, :, :]
                chars = x[b][rows[:, :, None], places[:, :, None] + np.arange(SPAN)[None, None, :]]
                np.add.at(grad["embed"], chars.ravel(), back.reshape(-1, CODES))
            t += 1
            for k, g in grad.items():
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                step = (one[k] / (1 - 0.9**t)) / (np.sqrt(two[k] / (1 - 0.999**t)) + 1e-8)
                w[k] = (w[k] - 0.004 * step).astype("float32")


def _newton(a: float, c: float, g: np.ndarray, h: np.ndarray) -> tuple[float, float]:
    """Slope and shift after one bounded step."""
    move = np.linalg.solve(h + 1e-6 * np.eye(2), g)
    return a - float(np.clip(move[0], -1, 1)), c - float(np.clip(move[1], -1, 1))


def _allowed(recall: float, secrets: int) -> int:
    """How many held-out secrets lie below the limit.

    It is the highest limit that keeps the recall, whatever alarms it costs. Half the misses
    that it allows are spent here, as few held-out findings tell it only roughly.
    """
    return int((1 - recall) * secrets / 2)


def train_network(
    windows: list[str], secret: np.ndarray, recall: float = RECALL, passes: int = PASSES[1], seed: int = SEED
) -> CharNetwork:
    """Fit in memory on four fifths of the findings, calibrate and set the limit on the rest.

    Without findings of both kinds in either part the network finds nothing.
    """
    rng = np.random.default_rng(seed)
    held = np.arange(len(windows)) % 5 == 4
    if any(len(np.unique(secret[part])) < 2 for part in (held, ~held)):
        return CharNetwork()
    x, y = codes(windows), secret.astype("float32")
    hidden = _without_cues(windows, secret, ~held, rng)
    x, y = np.concatenate([x, codes(hidden)]), np.concatenate([y, np.ones(len(hidden), "float32")])
    held = np.concatenate([held, np.zeros(len(hidden), bool)])
    net = CharNetwork(_first_weights(rng))
    own = np.flatnonzero(~held)
    _fit(net, x, y, own, _rarity(float((1 - y[own]).sum()), float(y[own].sum())), passes, rng)
    check = np.flatnonzero(held)
    score, truth = net.forward(x[check]), y[check]
    # Calibration: a logistic line through the held-out scores.
    a, c = 1.0, 0.0
    aim = (truth * truth.sum() + 1) / (truth.sum() + 2) * truth + (1 - truth) / ((1 - truth).sum() + 2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * score + c, -50, 50)))
        g = np.array([((p - aim) * score).mean(), (p - aim).mean()])
        v = p * (1 - p) + 1e-6
        h = np.array([[(v * score * score).mean(), (v * score).mean()], [(v * score).mean(), v.mean()]])
        a, c = _newton(a, c, g, h)
    net.slope, net.shift = a, c
    p = net.probability([windows[i] for i in check])
    found = np.sort(p[truth > 0])
    net.limit = float(found[_allowed(recall, len(found))])
    net.alarms = float((p[truth == 0] >= net.limit).mean())
    return net


def _without_cues(windows: list[str], secret: np.ndarray, train: np.ndarray, rng: np.random.Generator) -> list[str]:
    """Secrets of the training part in plain surroundings, and inside longer plain runs.

    Half of them have other first characters.
    """
    own, plain = (np.flatnonzero(train & (secret == kind)) for kind in (True, False))
    if not len(own) or not len(plain):
        return []
    out = []
    for i, j in zip(own, rng.choice(plain, len(own)), strict=True):
        body = windows[i][BEFORE : BEFORE + INSIDE]
        if rng.random() < 0.5:
            # As many letters of no kind as the prefixes of the rules have.
            body = "".join(rng.choice(list(TOKEN_LETTERS), 4)) + body[4:]
        before, after = windows[j][:BEFORE], windows[j][-AFTER:]
        out.append(before + body + after)
        ordinary = windows[j][BEFORE : BEFORE + INSIDE].rstrip("\0") or "\0"
        core = body.rstrip("\0")[: INSIDE - 10]
        filler = (ordinary * INSIDE)[:INSIDE]
        at = int(rng.integers(0, INSIDE - len(core) + 1))
        out.append(before + filler[:at] + core + filler[at + len(core) :] + after)
    return out


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """``(window, secret)``, the distinct windows of candidates in all documents, labelled by the rules.

    A window shows a secret if a finding of the rules overlaps it anywhere.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, bool] = {}
            for text in batch["text"].to_pylist():
                runs = candidates(text or "")
                spans = base_findings(text, runs) if runs else []
                for start, end in runs:
                    for shown, a, b in windows_of(text, start, end):
                        seen[shown] = seen.get(shown, False) or any(s < b and e > a for s, _, e in spans)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.bool_())],
                names=["window", "secret"],
            )

    found = docs.select("text").mapInArrow(label, "window string, secret boolean")
    return found.groupBy("window").agg(F.max("secret").alias("secret"))


def _training_shards(windows: DataFrame, shards: int, seed: int) -> DataFrame:
    """A row for each shard: its windows as character codes, their labels, which are held out, and counts."""

    def prepared(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.sort_by([("at", "ascending"), ("window", "ascending")])
        shown, secret = table["window"].to_pylist(), np.array(table["secret"].to_pylist(), bool)
        held = np.arange(len(shown)) % 5 == 4
        hidden = _without_cues(shown, secret, ~held, np.random.default_rng([seed, shard]))
        y = np.concatenate([secret, np.ones(len(hidden), bool)])
        held = np.concatenate([held, np.zeros(len(hidden), bool)])
        counts = {f"{n}_{k}": [int((y[p] == v).sum())] for n, p in (("fit", ~held), ("held", held)) for k, v in (("secret", True), ("plain", False))}
        x = codes(shown + hidden).astype("uint8").tobytes()
        own = {"shard": [shard], "x": [x], "y": [y.tobytes()], "held": [held.tobytes()], "hidden": [len(hidden)]}
        return pa.table(own | counts)

    dealt = windows.withColumn("at", F.xxhash64(F.lit(seed), "window"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "window"), F.lit(shards)))
    kinds = "hidden long, fit_secret long, fit_plain long, held_secret long, held_plain long"
    # As many partitions as shards, which adaptive execution does not put together.
    grouped = dealt.repartition(shards, "shard").groupBy("shard")
    return grouped.applyInArrow(prepared, f"shard long, x binary, y binary, held binary, {kinds}")


def _rows_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, labels and what is held out of one shard."""
    x = np.frombuffer(batch["x"][i].as_buffer(), "uint8").reshape(-1, WIDTH)
    y, held = (np.frombuffer(batch[c][i].as_buffer(), bool) for c in ("y", "held"))
    return x, y.astype("float32"), held


def _round(shards: DataFrame, weights: dict[str, np.ndarray], rare: float, number: int, seed: int) -> dict[str, np.ndarray]:
    """The mean weights after every shard has made a pass from the given ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch["shard"].to_pylist()):
                x, y, held = _rows_of(batch, i)
                net, own = CharNetwork({k: v.copy() for k, v in weights.items()}), np.flatnonzero(~held)
                _fit(net, x, y, own, rare, 1, np.random.default_rng([seed, shard, number]))
                flat = np.concatenate([net.weights[k].ravel() for k in _shapes()]).tobytes()
                yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(own)], "weights": [flat]})

    rows = sorted(shards.select("shard", "x", "y", "held").mapInArrow(run, "shard long, n long, weights binary").collect())
    share = np.array([r["n"] for r in rows], float)
    mean = sum(s * np.frombuffer(r["weights"], "float32") for s, r in zip(share / share.sum(), rows, strict=True))
    out, at = {}, 0
    for k, s in _shapes().items():
        out[k] = mean[at : at + int(np.prod(s))].reshape(s).astype("float32")
        at += int(np.prod(s))
    return out


def _calibrate(net: CharNetwork, scores: DataFrame, secrets: int, plain: int) -> None:
    """Slope and shift of a logistic line through the held-out ``(score, secret)``."""
    a, c = 1.0, 0.0
    s = F.col("score").cast("double")
    aim = F.when(F.col("secret"), F.lit((secrets + 1) / (secrets + 2))).otherwise(F.lit(1 / (plain + 2)))
    for _ in range(200):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), a * s + c))))
        own = scores.select(s.alias("s"), (p - aim).alias("off"), (p * (1 - p) + 1e-6).alias("v"))
        sums = own.agg(*(F.avg(F.expr(e)) for e in ("off * s", "off", "v * s * s", "v * s", "v"))).first()
        before = a, c
        a, c = _newton(a, c, np.array(sums[:2]), np.array([[sums[2], sums[3]], [sums[3], sums[4]]]))
        if max(abs(a - before[0]), abs(c - before[1])) < 1e-7:
            break
    net.slope, net.shift = a, c


def _kth(values: DataFrame, k: int) -> float:
    """The value of rank ``k`` from 0 in column ``v``, by counts in ever smaller ranges."""
    low, high = values.agg(F.min("v"), F.max("v")).first()
    while low < high:
        place = F.least(F.lit(BUCKETS - 1), F.floor((F.col("v") - low) / (high - low) * BUCKETS))
        inside = values.where(F.col("v").between(low, high)).groupBy(place.alias("place"))
        for row in sorted(inside.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()):
            if k < row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def train_on_documents(docs: DataFrame, recall: float = RECALL, seed: int = SEED, shard: int = SHARD) -> CharNetwork:
    """Fit on four fifths of all findings in the documents, calibrate and set the limit on the rest.

    The findings stay in tasks, about ``shard`` windows in a row; to the driver come the weights of every
    shard, sums and counts. Without findings of both kinds in either part the network finds nothing.
    """
    spark = docs.sparkSession
    with arrow_batch(spark, TEXTS_AT_ONCE):
        windows = stage(labelled_candidates(docs), "secret-windows")
    number = windows.count()
    if not number:
        return CharNetwork()
    shards = stage(_training_shards(windows, -(-number // shard), seed), "secret-shards")
    n = shards.groupBy().sum("fit_secret", "fit_plain", "held_secret", "held_plain", "hidden").first()
    fit_secret, fit_plain, held_secret, held_plain, hidden = n
    if not all((fit_secret - hidden, fit_plain, held_secret, held_plain)):
        return CharNetwork()
    net = CharNetwork(_first_weights(np.random.default_rng(seed)))
    passes = min(PASSES[1], max(PASSES[0], -(-SEEN // min(number, shard))))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y, held = _rows_of(batch, i)
                if held.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(net.scores(x[held]).astype("float32")), pa.array(y[held] > 0)], names=["score", "secret"]
                    )

    with arrow_batch(spark, 1):
        for i in range(passes):
            net.weights = _round(shards, net.weights, _rarity(fit_plain, fit_secret), i, seed)
        scores = stage(shards.select("x", "y", "held").mapInArrow(scored, "score float, secret boolean"), "secret-scores")
    _calibrate(net, scores, held_secret, held_plain)
    # Probabilities rise or fall with the scores.
    up = 1 if net.slope >= 0 else -1
    ranked = scores.select("secret", (up * F.col("score").cast("double")).alias("v"))
    least = _kth(ranked.where("secret"), _allowed(recall, held_secret))
    net.limit = float(net.calibrated(np.array([up * least], "float32"))[0])
    net.alarms = ranked.where(~F.col("secret") & (F.col("v") >= least)).count() / held_plain
    return net


def _slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts as Python strings, some at a time."""
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield texts.slice(at, TEXTS_AT_ONCE).to_pylist()


def _findings(network: CharNetwork, texts: pa.Array) -> list[list[Span]]:
    """Findings ``(start, kind, end)`` of every text in their order."""
    spans: list[list[Span]] = []
    asked: list[tuple[int, int, int]] = []
    windows: list[str] = []
    accepted: dict[tuple[int, int, int], None] = {}

    def ask() -> None:
        p = network.probability(windows)
        accepted.update((a, None) for a, yes in zip(asked, p >= network.limit, strict=True) if yes)
        asked.clear()
        windows.clear()

    for i, text in enumerate(t or "" for some in _slices(texts) for t in some):
        runs = candidates(text)
        base = base_findings(text, runs)
        spans.append(base)
        for start, end in uncovered(runs, base):
            # A candidate is found by any of its windows.
            for shown, _, _ in windows_of(text, start, end):
                asked.append((i, start, end))
                windows.append(shown)
                if len(windows) >= 8192:
                    ask()
    ask()
    for i, start, end in accepted:
        spans[i].append((start, 3, end))
    return [sorted(own) for own in spans]


def find_secrets(docs: DataFrame, network: CharNetwork) -> DataFrame:
    """All rows of ``docs`` with ``secrets``, the findings in each whole text.

    A finding is ``(start, kind, end)`` in code points, ordered by start and kind; kinds
    are numbered as in ``KINDS``. A null or empty text has none, a very long one is searched
    whole, repeated rows are searched each, a column of that name is replaced, an empty table stays empty.
    """

    @F.arrow_udf("array<struct<start: int, kind: int, end: int>>")
    def found(texts: pa.Array) -> pa.Array:
        spans = _findings(network, texts)
        flat = [s for own in spans for s in own]
        ends = np.cumsum([0, *map(len, spans)]).astype("int32")
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        items = pa.StructArray.from_arrays(
            [pa.array(c, pa.int32()) for c in columns], names=["start", "kind", "end"]
        )
        return pa.ListArray.from_arrays(pa.array(ends), items)

    plain = docs.drop("secrets")
    return plain.withColumn("secrets", found("text"))


def without_secrets(docs: DataFrame, network: CharNetwork) -> DataFrame:
    """All rows of ``docs`` with every finding in ``text`` replaced by ``[SECRET]``.

    Findings that overlap are replaced as one; null and empty texts stay as they are, very long
    ones are searched whole, repeated rows are masked each, a column ``secrets`` is dropped,
    and an empty table stays empty.
    """

    def hidden(text: str, spans: list[Span]) -> str:
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    # Found and masked in one call: two calls in a row would keep two Python workers a core.
    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        spans = iter(_findings(network, texts))
        out = [pa.array([hidden(t, s) if (s := next(spans)) else t for t in some], pa.string()) for some in _slices(texts)]
        return pa.concat_arrays([pa.array([], pa.string()), *out])

    return docs.drop("secrets").withColumn("text", masked("text"))
