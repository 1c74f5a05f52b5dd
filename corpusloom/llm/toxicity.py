"""Severity of toxic language by cumulative-link ordinal regression.

Features of a text are its words and their beginnings, so inflected forms share what
their stems say. All grades share one weight vector; every grade has a threshold on
the same score, P(grade > j) = sigmoid(score - threshold_j), and thresholds are
ordered. The expected severity is the sum of these probabilities.

Labels say toxic or not. Grades above the first come from the labelled toxic texts
themselves: features that toxic texts have far more often than others speak for toxicity,
and the toxic texts are graded by thirds of the share of such words in them. The fit runs on the
driver over the telling features of a bounded sample of labelled rows (``train_rows``);
everything else is done where the documents are.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.samples import about
from corpusloom.session import arrow_batch, stage

TRAIN_ROWS = 12_000
STEM_BYTES = (4, 5, 6)
# Likelihood ratio by which a feature's share of toxic texts must differ from the rest: by
# chance one of some ten thousand features has as much. And toxic texts that must hold it.
EVIDENCE = 15.0
FEWEST = 3
ALIKE = 0.6
BANDS, BAND_ROWS = 12, 4
GRADES = 4
SEED = 31
HASHES = np.random.default_rng(SEED).integers(1, 1 << 32, (BANDS * BAND_ROWS, 1), "uint64") | 1
# Most words of many texts are rare; a table of five times as many saves a sixth of the time.
WORDS_KEPT = 100_000
TEXTS_AT_ONCE = 500
# ASCII characters that are no part of a word become spaces.
BLANK = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()),
    b" " * sum(not chr(c).isalnum() for c in range(128)),
)
SCORED = pa.schema([("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])


def word_counts(text: str | None) -> Counter:
    """Words of a whole text in ASCII lower case, with their numbers; null has none."""
    return Counter((text or "").encode().translate(BLANK).lower().split())


def word_features(word: bytes) -> list[bytes]:
    return [word, *(word[:n] + b"*" for n in STEM_BYTES if len(word) >= n)]


def strength(count: np.ndarray) -> np.ndarray:
    """What a word's number of occurrences adds; repeats count less and less."""
    return 1 + np.log(count)


@dataclass
class Sparse:
    """Rows of sparse features."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int
    columns: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], minlength=self.rows)

    def transposed_times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * x[self.row], minlength=self.columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(
    features: Sparse, grade: np.ndarray, grades: int, steps: int = 400, penalty: float = 1e-5,
    balance: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam.

    Thresholds are the first one and positive gaps above it, which keeps their order.
    Texts of a threshold's two sides have equal weight in its loss.
    """
    over = (grade[:, None] > np.arange(grades - 1)[None, :]).astype(float)
    share = np.clip(over.mean(axis=0), 1e-3, 1 - 1e-3) if balance else np.full(grades - 1, 0.5)
    cost = np.where(over > 0, 0.5 / share, 0.5 / (1 - share)) / len(grade)
    theta = np.zeros(features.columns + grades - 1)
    theta[features.columns] = 1.0
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        weights, free = theta[: features.columns], theta[features.columns :]
        gaps = np.exp(free[1:])
        cuts = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        off = (sigmoid(features.times(weights)[:, None] - cuts[None, :]) - over) * cost
        by_cut = -off.sum(axis=0)
        slope = np.concatenate(
            [
                features.transposed_times(off.sum(axis=1)) + penalty * weights,
                [by_cut.sum()],
                gaps * np.cumsum(by_cut[::-1])[::-1][1:],
            ]
        )
        one = 0.9 * one + 0.1 * slope
        two = 0.999 * two + 0.001 * slope * slope
        theta = theta - 0.05 * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-9)
    free = theta[features.columns :]
    cuts = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return theta[: features.columns], cuts


@dataclass
class SeverityModel:
    weights: dict[bytes, float] = field(default_factory=dict)
    cuts: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))
    reject_over: float = 0.5
    seen: dict[bytes, float] = field(default_factory=dict)

    def word_weight(self, word: bytes) -> float:
        """Weights of all features of a word; what was summed before is kept."""
        weight = self.seen.get(word)
        if weight is None:
            if len(self.seen) >= WORDS_KEPT:
                self.seen.clear()
            weight = sum(self.weights.get(f, 0.0) for f in word_features(word))
            self.seen[word] = weight
        return weight

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) for every text and every j."""
        scores = np.zeros(len(texts))
        for i, text in enumerate(texts):
            for word, n in word_counts(text).items():
                if weight := self.word_weight(word):
                    scores[i] += weight * float(strength(np.float64(n)))
        with np.errstate(over="ignore"):
            return sigmoid(scores[:, None] - self.cuts[None, :])


def signature(words: list[bytes]) -> np.ndarray:
    """Minimum hashes of a text's distinct words."""
    own = np.fromiter(map(zlib.crc32, words), "uint64", len(words))
    least = ((own[None, :] * HASHES) & 0xFFFFFFFF).min(axis=1, initial=0xFFFFFFFF)
    return least.astype("uint32")


def first_of_copies(signatures: np.ndarray) -> list[int]:
    """Places of texts that are no near copies, by their words, of an earlier one.

    Copies of one toxic text would make all of its words look toxic. Texts that agree in
    a band of minimum hashes are compared by all of them.
    """
    kept: list[int] = []
    by_band: dict[tuple, list[int]] = {}
    for i, own in enumerate(signatures):
        keys = [(b, own[b * BAND_ROWS : (b + 1) * BAND_ROWS].tobytes()) for b in range(BANDS)]
        near = {j for k in keys for j in by_band.get(k, ())}
        if not any((own == signatures[j]).mean() >= ALIKE for j in near):
            kept.append(i)
            for k in keys:
                by_band.setdefault(k, []).append(i)
    return kept


def features_with_counts(texts: list[list[bytes]]) -> Counter:
    """In how many texts every feature stands."""
    count: Counter = Counter()
    for words in texts:
        count.update({f for w in words for f in word_features(w)})
    return count


def telling_features(with_toxic: dict[bytes, int], with_clean: dict[bytes, int], n1: int, n0: int) -> list[bytes]:
    """Features that toxic texts have far more often than their share of all texts."""
    names = [f for f, k in with_toxic.items() if k >= FEWEST]
    k1 = np.array([with_toxic[f] for f in names], float)
    k0 = np.array([with_clean.get(f, 0) for f in names], float)
    base = n1 / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        clean = np.where(k0 > 0, k0 * np.log(k0 / ((k1 + k0) * (1 - base))), 0.0)
        ratio = 2 * (k1 * np.log(k1 / ((k1 + k0) * base)) + clean)
    told = (ratio > EVIDENCE) & (k1 * n0 > 5 * k0 * n1)
    return sorted(f for f, t in zip(names, told, strict=True) if t)


def own_features(words: list[bytes], counts: list[int], vocabulary: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Columns of a text's features in the vocabulary, and the numbers of their words."""
    found = [(at, n) for w, n in zip(words, counts, strict=True) for f in word_features(w) if (at := vocabulary.get(f)) is not None]
    return [at for at, _ in found], [n for _, n in found]


def fit_features(
    found: list[tuple[list[int], list[int]]], totals: np.ndarray, toxic: np.ndarray, names: list[bytes], grades: int = GRADES
) -> SeverityModel:
    """A model from the features of texts, their numbers of words and their labels."""
    value = np.array([n for _, counts in found for n in counts], float)
    features = Sparse(
        np.repeat(np.arange(len(found)), [len(at) for at, _ in found]),
        np.array([c for at, _ in found for c in at], int), strength(value), len(found), len(names),
    )
    # Thirds of the toxic texts that show such features, by how much of them they show.
    shown = np.bincount(features.row, features.value, minlength=features.rows)
    share = shown / np.sqrt(np.maximum(1, totals))
    loud = (toxic == 1) & (shown > 0)
    grade = toxic.astype(int)
    limits = np.quantile(share[loud], np.arange(1, grades - 1) / (grades - 1))
    grade[loud] = 1 + np.searchsorted(limits, share[loud], side="right")
    weights, cuts = fit_ordinal(features, grade, grades)
    model = SeverityModel({f: float(weights[i]) for i, f in enumerate(names)}, cuts)
    severity = sigmoid(features.times(weights)[:, None] - cuts[None, :]).sum(axis=1)
    # The limit lies where the two classes err least, nearer to the clean side.
    order = np.argsort(severity, kind="stable")
    ranked, label = severity[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(label) / label.sum()])
    alarms = np.concatenate([np.cumsum((1 - label)[::-1])[::-1] / (1 - label).sum(), [0]])
    between = np.concatenate([[True], ranked[1:] > ranked[:-1], [True]])
    at = int(np.argmin(np.where(between, missed + 5 * alarms, np.inf)))
    low = ranked[at - 1] if at > 0 else ranked[0] - 1
    high = ranked[at] if at < len(ranked) else ranked[-1] + 1
    model.reject_over = float(low + 0.2 * (high - low))
    return model


def fit_severity(
    texts: list[tuple[list[bytes], list[int]]], toxic: np.ndarray, grades: int = GRADES
) -> SeverityModel:
    """A model from the distinct words of labelled texts and their numbers, in memory.

    With one class only, or no word that tells the classes apart, it rejects nothing.
    """
    first = first_of_copies(np.array([signature(words) for words, _ in texts]).reshape(len(texts), -1))
    texts, toxic = [texts[i] for i in first], np.asarray(toxic)[first]
    if not len(texts) or toxic.min() == toxic.max():
        return SeverityModel()
    by_label = [features_with_counts([w for (w, _), t in zip(texts, toxic, strict=True) if t == label]) for label in (0, 1)]
    names = telling_features(by_label[1], by_label[0], int((toxic == 1).sum()), int((toxic == 0).sum()))
    if not names:
        return SeverityModel()
    vocabulary = {f: i for i, f in enumerate(names)}
    found = [own_features(w, c, vocabulary) for w, c in texts]
    return fit_features(found, np.array([sum(c) for _, c in texts]), toxic, names, grades)


def labelled_words(docs: DataFrame, labels: DataFrame, rows: int, seed: int) -> DataFrame:
    """A stored sample of the labelled documents: label, distinct words with numbers, signature.

    The sample of labels is drawn first and travels to the documents.
    """
    wanted = about(
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic")),
        "doc_id",
        rows,
        seed,
    )
    rows_of = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [word_counts(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pc.greater(batch["toxic"], 0).cast(pa.int32()),
                    pa.array([b" ".join(c) for c in own], pa.binary()),
                    pa.array([list(c.values()) for c in own], pa.list_(pa.int32())),
                    pa.array([signature(list(c)).tobytes() for c in own], pa.binary()),
                ],
                names=["doc_id", "toxic", "words", "counts", "signature"],
            )

    found = rows_of.mapInArrow(counted, "doc_id long, toxic int, words binary, counts array<int>, signature binary")
    with arrow_batch(docs.sparkSession, TEXTS_AT_ONCE):
        return stage(found.withColumn("key", F.xxhash64("doc_id", "words", "counts")), "labelled")


def _counted_features(texts: DataFrame, among: set[bytes] | None = None) -> DataFrame:
    """``(feature, n)`` over the texts, added up in every task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for words in batch["words"].to_pylist():
                own = {f for w in words.split() for f in word_features(w)}
                total.update(own if among is None else own & among)
        names = list(total)
        for at in range(0, len(names), 100_000):
            part = names[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([total[f] for f in part], pa.int64())], names=["feature", "n"]
            )

    counted = texts.select("words").mapInArrow(count, "feature binary, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def train_severity(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = SEED
) -> SeverityModel:
    """Fit on some ``train_rows`` labelled documents.

    The texts stay in the tasks. To the driver come signatures of the sample, features that
    some toxic texts of it share, and last the few telling ones of every text.
    """
    sample = labelled_words(docs, labels, train_rows, seed)
    rows = sample.select("doc_id", "key", "toxic", "signature").toArrow().sort_by([("doc_id", "ascending"), ("key", "ascending")])
    signs = np.frombuffer(b"".join(rows["signature"].to_pylist()), "uint32").reshape(-1, len(HASHES))
    first = first_of_copies(signs)
    toxic = rows["toxic"].to_numpy()[first]
    n1 = int(toxic.sum())
    if n1 in (0, len(first)):
        return SeverityModel()
    # As an Arrow table they reach the tasks without Python workers.
    keys = docs.sparkSession.createDataFrame(pa.table({"key": rows["key"].to_numpy()[first]}))
    kept = sample.dropDuplicates(["key"]).join(F.broadcast(keys), "key", "left_semi")
    kept = stage(kept, "kept")
    shared = _counted_features(kept.where("toxic = 1")).where(F.col("n") >= FEWEST).toArrow()
    with_toxic = dict(zip(shared["feature"].to_pylist(), shared["n"].to_pylist(), strict=True))
    clean = _counted_features(kept.where("toxic = 0"), set(with_toxic)).toArrow()
    with_clean = dict(zip(clean["feature"].to_pylist(), clean["n"].to_pylist(), strict=True))
    names = telling_features(with_toxic, with_clean, n1, len(first) - n1)
    if not names:
        return SeverityModel()
    vocabulary = {f: i for i, f in enumerate(names)}

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch["counts"].to_pylist()
            found = [own_features(w.split(), c, vocabulary) for w, c in zip(batch["words"].to_pylist(), counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["toxic"],
                    pa.array([sum(c) for c in counts], pa.int64()),
                    pa.array([at for at, _ in found], pa.list_(pa.int32())),
                    pa.array([n for _, n in found], pa.list_(pa.int32())),
                ],
                names=["key", "toxic", "total", "features", "counts"],
            )

    texts = kept.select("key", "toxic", "words", "counts").mapInArrow(
        told, "key long, toxic int, total long, features array<int>, counts array<int>"
    )
    texts = texts.toArrow().sort_by("key")
    found = list(zip(texts["features"].to_pylist(), texts["counts"].to_pylist(), strict=True))
    return fit_features(found, texts["total"].to_numpy(), texts["toxic"].to_numpy(), names)


def score_severity(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """All rows of ``docs`` with ``severity``, ``grade`` and ``toxic``.

    A null or empty text has no words and is not toxic; a very long one is scored whole;
    repeated rows are scored each, columns of the three names are replaced, all others stay
    whatever they are called, and an empty table stays empty.
    """
    plain = docs.drop(*SCORED.names)
    own = "_scored"
    while own in plain.columns:
        own = "_" + own

    @F.arrow_udf("severity double, grade int, toxic boolean")
    def scored(texts: pa.Array) -> pa.Array:
        some = [texts.slice(at, TEXTS_AT_ONCE) for at in range(0, len(texts), TEXTS_AT_ONCE)]
        over = np.concatenate([model.probabilities([]), *(model.probabilities(s.to_pylist()) for s in some)])
        severity = over.sum(axis=1)
        columns = [severity, (over > 0.5).sum(axis=1).astype("int32"), severity > model.reject_over]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(SCORED))

    rows = plain.withColumn(own, scored("text"))
    return rows.select(*[F.col(f"`{c}`") for c in plain.columns], f"{own}.*")
