"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of its distinct five-word shingles, as 64-bit hashes. Its sketch
is the k smallest of them. Documents with equal sets are one class; classes that share
retained values are found by inverted lists, the share of common values among the k
smallest of two sketches together estimates their resemblance, and pairs that pass are
compared on their full sets. Components of the confirmed links are the groups.

* Two sets of resemblance 0.75 or more have at least ``NEED`` of their 32 smallest
  values in common but for a chance of about 1e-7.
* A class with too few values that any other retains has no link and drops out.
* First every class is compared with the heads of its lists that it meets most often, a
  number of pairs in proportion to the classes. That connects most copies of a text, and
  all that follows looks only at what is still in different components.
* An inverted list of up to ``LIST`` classes gives all such pairs. In a longer one no
  pairs are spread out: a class with too few values of long lists cannot owe a link to
  them alone. The others are compared with one head of each list, and those that are still
  apart with all others in blocks of bounded size inside tasks. There a wider sketch decides,
  of the ``WIDE`` smallest values: up to the smaller of two sketches' ends both are whole, and
  what they share up to there estimates the resemblance within ``SLACK`` standard errors, again
  but for a chance of about 1e-7; sets that fit their sketch are compared exactly. The best
  partners come out, and more of them in every further round, until nothing that could be
  a link is left between components.
* Copies share a class and meet only in counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import arrow_batch, stage

WORDS = 5
KEPT, INDEXED = 48, 32
NEED = 11
ESTIMATE = 20 / 48
LIST = 24
WIDE, SLACK = 160, 5.3
BLOCK = 2_000
BEST = 2
PARTNERS = 8
SETS_AT_ONCE = 500
BROADCAST_CLASSES = 400_000
BASE = 0x9E3779B97F4A7C15 | 1
SKETCH_DDL = "doc_id long, n_shingles long, class_key binary, sketch array<long>"


class Shingler:
    """Shingle hashes of texts from running sums over their bytes.

    The bytes of the words, one space apart, stand for 64-bit values; a shingle is the
    sum of its values times rising powers of an odd base, moved to position 0. The sums
    of all shingles come from one running sum.
    """

    def __init__(self, words: int = WORDS, seed: int = 5):
        self.words = words
        self.value = np.random.default_rng(seed).integers(1, 1 << 63, 256, "uint64")
        self.powers = self.inverse = np.ones(1, "uint64")

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            size = 1 << size.bit_length()

            def rising(base: int) -> np.ndarray:
                steps = np.full(size, base, "uint64")
                steps[0] = 1
                return np.multiply.accumulate(steps)

            self.powers = rising(BASE)
            self.inverse = rising(pow(BASE, -1, 1 << 64))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; fewer words than a shingle has count as one."""
        joined = b" ".join((text or "").encode().lower().split())
        if not joined:
            return np.zeros(0, "uint64")
        raw = np.frombuffer(joined, "uint8")
        self._grow(len(raw) + 1)
        total = np.zeros(len(raw) + 1, "uint64")
        np.cumsum(self.value[raw] * self.powers[: len(raw)], out=total[1:])
        gaps = np.flatnonzero(raw == 32)
        begin = np.concatenate([[0], gaps + 1])
        end = np.concatenate([gaps, [len(raw)]])
        n = max(1, len(begin) - self.words + 1)
        begin, end = begin[:n], end[-n:]
        own = (total[end] - total[begin]) * self.inverse[begin]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            own = (own ^ (own >> np.uint64(shift))) * np.uint64(factor)
        # 63 bits keep the order of the hashes in Spark's signed integers.
        return np.unique((own ^ (own >> np.uint64(31))) >> np.uint64(1))


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, digest of the set and sketch of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler()
        for batch in batches:
            counts, keys, smallest = [], [], []
            for text in batch["text"].to_pylist():
                found = own.shingles(text)
                counts.append(len(found))
                full = len(found) > 0
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if full else None)
                smallest.append(found[:KEPT].astype("int64"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(smallest, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class_key", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCH_DDL)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full sets of classes ``(cid, doc_id, class_key)`` as ``(cid, items, wide)``.

    ``wide`` holds the upper halves of the smallest values, which keep their order.
    """
    few = wanted.count() <= BROADCAST_CLASSES
    side = wanted.withColumnRenamed("doc_id", "known")
    side = F.broadcast(side) if few else side
    rows = docs.select("doc_id", "text").join(side, F.col("doc_id").eqNullSafe(F.col("known")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids, items, wide = [], [], []
                columns = (some[c].to_pylist() for c in ("cid", "class_key", "text"))
                for cid, key, text in zip(*columns, strict=True):
                    found = own.shingles(text)
                    # Rows that share a doc_id may differ in their text.
                    if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == key:
                        ids.append(cid)
                        items.append(found.tobytes())
                        wide.append((found[:WIDE] >> np.uint64(31)).astype("uint32").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(items, pa.binary()), pa.array(wide, pa.binary())],
                    names=["cid", "items", "wide"],
                )

    found = rows.select("cid", "class_key", "text").mapInArrow(run, "cid long, items binary, wide binary")
    return found


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose full sets resemble each other enough."""

    @F.arrow_udf("boolean")
    def close(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = (np.frombuffer(s.as_buffer(), "uint64") for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= 75 * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    one = sets.select(F.col("cid").alias("a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("cid").alias("b"), F.col("items").alias("items_b"))
    joined = pairs.select("a", "b").distinct().join(two, "b").join(one, "a")
    return joined.where(close("items_a", "items_b")).select("a", "b")


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with the estimate from their sketches together, if it is enough."""
    sketch = classes.select("cid", "sketch")
    both = (
        pairs.join(sketch.withColumnsRenamed({"cid": "a", "sketch": "sa"}), "a")
        .join(sketch.withColumnsRenamed({"cid": "b", "sketch": "sb"}), "b")
        .withColumn("lowest", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, KEPT))
        .withColumn("shared", F.array_intersect("sa", "sb"))
    )
    share = F.size(F.array_intersect("lowest", "shared")) / F.size("lowest")
    return both.select("a", "b", share.alias("estimate")).where(F.col("estimate") >= ESTIMATE)


def components(links: DataFrame) -> DataFrame:
    """``(cid, component)``, the smallest cid that links lead to, for all nodes of links.

    Every round takes the smallest label among neighbours and then the label of that
    label, so a chain takes a number of rounds in the logarithm of its length.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("cid"), F.least("a", "m").alias("component")
    )
    labels = stage(labels, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("cid").alias("b"), "component"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("m"))
        )
        low = labels.join(near, F.col("cid") == F.col("a")).select(
            "cid", F.col("component").alias("was"), F.least("component", "m").alias("low")
        )
        low = stage(low, "labels-low")
        jump = low.select(F.col("cid").alias("at"), F.col("low").alias("far"))
        after = low.join(jump, F.col("low") == F.col("at"), "left").select(
            "cid", "was", F.least("low", F.coalesce("far", "low")).alias("component")
        )
        after = stage(after, "labels")
        labels = after.select("cid", "component")
        if after.where("was <> component").isEmpty():
            return labels


def _head_pairs(postings: DataFrame, best: int) -> DataFrame:
    """Every class with the ``best`` heads that it meets in most of its lists.

    The head of a list is its member whose own lists are longest together: of edited copies
    that is the one which has most in common with the others, mostly their source.
    """
    heads = postings.groupBy("v").agg(F.max(F.struct("weight", "cid", "n_shingles")).alias("head"))
    met = (
        postings.join(heads, "v")
        .where("cid <> head.cid AND 4 * least(n_shingles, head.n_shingles) >= 3 * greatest(n_shingles, head.n_shingles)")
        .groupBy("cid", F.col("head.cid").alias("head"))
        .agg(F.count("*").alias("lists"))
    )
    # At most as many heads as a class has indexed values.
    most = Window.partitionBy("cid").orderBy(F.desc("lists"), "head")
    top = met.withColumn("place", F.row_number().over(most)).where(F.col("place") <= best)
    return top.select(F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()


def _labelled(frame: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """The frame with the component of a column's class, which is the class itself without links."""
    known = labels.select(F.col("cid").alias("_cid"), F.col("component").alias("_label"))
    joined = frame.join(known, frame[column] == F.col("_cid"), "left")
    return joined.withColumn(name, F.coalesce("_label", column)).drop("_cid", "_label")


def _star_pairs(crowded: DataFrame) -> DataFrame:
    """Every member of a long list with the member that has most values of long lists."""
    heads = crowded.groupBy("v").agg(F.max(F.struct("n_long", "cid"))["cid"].alias("head"))
    met = crowded.select("v", "cid").join(heads, "v").where("cid <> head")
    return met.select(F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()


def _dealt(members: DataFrame) -> DataFrame:
    """The members of every list with their comparisons ``(v, i, j)``, and as what they take part.

    Block ``j`` is a part of the list that part ``i`` of those that ask is compared with. A member
    stands in its own block for every part, and one that asks once in every other block; a list
    of up to ``BLOCK`` members is one comparison with a row for each.
    """
    parts = [F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int") for n in (F.count_if("ask"), F.count("*"))]
    sizes = members.groupBy("v").agg(parts[0].alias("asking"), parts[1].alias("blocks"))
    known = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    asker = F.pmod(F.xxhash64(F.lit(1), "cid"), F.col("asking")).cast("int")

    def place(i, j, listed, ask):
        return F.struct(i.alias("i"), j.alias("j"), listed.alias("listed"), ask.alias("ask"))

    own = F.transform(
        F.sequence(F.lit(0), F.col("asking") - 1),
        lambda i: place(i, F.col("known"), F.lit(True), F.col("ask") & (i == F.col("asker"))),
    )
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.col("ask") & (j != F.col("known")))
    others = F.transform(others, lambda j: place(F.col("asker"), j, F.lit(False), F.lit(True)))
    rows = members.join(sizes, "v").withColumn("known", known).withColumn("asker", asker)
    rows = rows.withColumn("place", F.explode(F.concat(own, others)))
    return rows.drop("ask", "asking", "blocks", "known", "asker").select("*", "place.*").drop("place")


def _block_pairs(members: DataFrame, best: int) -> DataFrame:
    """Pairs between components within long lists, compared block by block.

    ``members`` is ``(v, cid, n_shingles, keys, sketch, wide, component, ask)``; members that do
    not ask are only compared with those that do. A pair is looked at in the list of
    its smallest common key. Of each member that asks the ``best``
    partners of a block come out, as ``(v, cid, a, b, withheld)``: whether it has more.
    """

    def grid_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted value codes of every row, padded with the number of values."""
        lists = column.combine_chunks()
        values, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        width = np.diff(lists.offsets.to_numpy())
        grid = np.full((len(width), max(1, int(width.max(initial=0)))), len(values))
        grid[np.arange(grid.shape[1])[None, :] < width[:, None]] = code
        return np.sort(grid, axis=1), values

    def compare(table: pa.Table) -> pa.Table:
        ids, sizes = table["cid"].to_numpy(), table["n_shingles"].to_numpy()
        part = table["component"].to_numpy()
        listed, asking = (np.array(table[c].to_pylist(), bool) for c in ("listed", "ask"))
        grid, values = grid_of(table["sketch"])
        keys, key_values = grid_of(table["keys"])
        v = int(np.searchsorted(key_values, table["v"][0].as_py()))
        flag, key_flag = np.zeros(len(values) + 1, bool), np.zeros(len(key_values) + 1, bool)
        need = np.minimum(NEED, np.ceil(sizes * 0.5))
        shown = [np.frombuffer(b.as_buffer(), "uint32") for b in table["wide"].combine_chunks()]
        width = np.array([len(s) for s in shown])
        wide = np.zeros((len(shown), WIDE), "uint32")
        for row, own in zip(wide, shown, strict=True):
            row[: len(own)] = own
        # Up to its last value a sketch is whole; one that holds the set is whole everywhere.
        cut = sizes > WIDE
        whole = np.where(cut, wide[np.arange(len(wide)), width - 1].astype("int64"), 1 << 32)

        def close(x: int, near: np.ndarray) -> np.ndarray:
            own, theirs = wide[x, : width[x]], wide[near]
            held = np.arange(WIDE)[None, :] < width[near][:, None]
            place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            both = ((own[place] == theirs) & held).sum(axis=1)
            limit = np.minimum(whole[x], whole[near])
            union = np.searchsorted(own, limit, side="right") + ((theirs <= limit[:, None]) & held).sum(axis=1) - both
            guess = both / union >= 0.75 - SLACK * np.sqrt(0.1875 / union)
            return np.where(cut[x] | cut[near], guess, 100 * both >= 75 * union)

        left, right, asked, withheld = [], [], [], []
        for x in np.flatnonzero(asking):
            ok = listed & (part != part[x])
            ok &= 4 * np.minimum(sizes, sizes[x]) >= 3 * np.maximum(sizes, sizes[x])
            near = np.flatnonzero(ok)
            key_flag[keys[x]] = True
            key_flag[-1] = False
            common = key_flag[keys[near]]
            key_flag[keys[x]] = False
            near = near[keys[near, common.argmax(axis=1)] == v]
            flag[grid[x]] = True
            flag[-1] = False
            shared = flag[grid[near]].sum(axis=1)
            flag[grid[x]] = False
            enough = shared >= np.maximum(need[near], need[x])
            near, shared = near[enough], shared[enough]
            alike = close(x, near)
            near, shared = near[alike], shared[alike]
            partners = ids[near[np.lexsort((ids[near], -shared))[:best]]]
            left.append(np.minimum(partners, ids[x]))
            right.append(np.maximum(partners, ids[x]))
            asked.append(np.full(len(partners), ids[x]))
            withheld.append(np.full(len(partners), len(near) > best))
        none = np.zeros(0, "int64")
        return pa.table(
            {
                "v": np.full(sum(map(len, left)), table["v"][0].as_py()),
                "cid": np.concatenate([none, *asked]),
                "a": np.concatenate([none, *left]),
                "b": np.concatenate([none, *right]),
                "withheld": np.concatenate([none.astype(bool), *withheld]),
            }
        )

    # Many small tasks, which adaptive execution does not put together by their bytes.
    tasks = 8 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        _dealt(members)
        .repartition(tasks, "v", "i", "j")
        .groupBy("v", "i", "j")
        .applyInArrow(compare, "v long, cid long, a long, b long, withheld boolean")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Group of every document ``(doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of characters other than ASCII white space, A-Z in lower case. A null
    text, or one without words, has an empty set and is a group of its own. Repeated rows
    have equal sets and share a group. The group of documents that all have a null doc_id
    is null, and those are kept; in other groups a null is no smallest id and not kept.
    Other columns are not read, and an empty table gives no rows.
    """
    with arrow_batch(docs.sparkSession, SETS_AT_ONCE):
        read = stage(sketches(docs), "sketches")
    some = read.where("n_shingles > 0")
    first = some.groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("least")
    )
    classes = (
        first.withColumn("cid", F.monotonically_increasing_id())
        .selectExpr("cid", "class_key", "least.doc_id AS doc_id")
    )
    classes = stage(classes, "classes")
    shown = classes.join(
        some.select(F.col("class_key").alias("key"), F.col("doc_id").alias("own"), "n_shingles", "sketch"),
        (F.col("class_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("own")),
    ).dropDuplicates(["cid"])
    shown = stage(shown.select("cid", "n_shingles", "sketch"), "class-sketches")

    # Inverted lists of the values that several classes retain.
    spread = shown.select("cid", "n_shingles", F.explode(F.slice("sketch", 1, INDEXED)).alias("v"))
    lengths = spread.groupBy("v").agg(F.count("*").alias("length")).where("length > 1")
    need = F.least(F.lit(NEED), F.ceil(F.col("n_shingles") * 0.5)).cast("int")
    # Linked classes have as many indexed values in common, so each has as many in lists.
    held = spread.join(lengths, "v")
    alive = held.groupBy("cid", "n_shingles").agg(F.count("*").alias("values"), F.sum("length").alias("weight"))
    alive = stage(alive.where(F.col("values") >= need).select("cid", "weight"), "alive")
    postings = stage(held.join(alive, "cid"), "postings")
    with arrow_batch(docs.sparkSession, SETS_AT_ONCE):
        sets = stage(_sets(docs, classes.join(alive.select("cid"), "cid")).dropDuplicates(["cid"]), "sets")
        tried = stage(_estimated(_head_pairs(postings, BEST), shown).select("a", "b"), "tried-heads")
        links = stage(_linked(tried, sets), "links-heads")
    labels = components(links)

    long = (
        postings.where(F.col("length") > LIST)
        .groupBy("cid")
        .agg(F.count("*").alias("n_long"), F.sort_array(F.collect_list(F.struct("length", "v"))).alias("held"))
    )
    short = postings.where(F.col("length") <= LIST).join(long.select("cid", "n_long"), "cid", "left")
    short = short.select("v", "cid", "n_shingles", F.coalesce("n_long", F.lit(0)).alias("n_long"))
    short = stage(_labelled(short, labels, "cid", "component"), "short")
    # Lists within one component are done.
    several = short.groupBy("v").agg((F.min("component") < F.max("component")).alias("open")).where("open")
    short = short.join(several.select("v"), "v", "left_semi")
    names = {"a": "cid", "na": "n_shingles", "la": "n_long", "ca": "component"}
    one = short.select("v", *(F.col(c).alias(n) for n, c in names.items()))
    two = short.select("v", *(F.col(c).alias(n.replace("a", "b")) for n, c in names.items()))
    met = (
        one.join(two, "v")
        .where("a < b AND ca <> cb AND 4 * least(na, nb) >= 3 * greatest(na, nb)")
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.first(F.least("la", "lb")).alias("more"), F.first(F.least("na", "nb")).alias("n_shingles"))
        .where(F.col("shared") + F.col("more") >= need)
    )
    pairs = stage(_estimated(met.select("a", "b"), shown), "pairs")

    # Classes that may owe a link to long lists alone, and the lists to look for it in.
    crowded = (
        long.join(shown, "cid")
        .where(F.col("n_long") >= need)
        .withColumn("first", F.greatest(F.lit(0), F.col("n_long").cast("int") - need + 1))
        .withColumn("keys", F.transform(F.slice("held", F.lit(1), F.col("first")), lambda h: h["v"]))
        .select("cid", "n_shingles", "n_long", "sketch", "keys", F.explode("keys").alias("v"))
    )
    crowded = stage(crowded, "crowded")
    wide = sets.select("cid", "wide")
    apart = _labelled(_labelled(_star_pairs(crowded), labels, "a", "ca"), labels, "b", "cb").where("ca <> cb")
    stars = stage(_estimated(apart.select("a", "b"), shown), "stars")

    # Next round: the best partners of each and the heads of long lists.
    ends = pairs.select("a", "b", "estimate", F.explode(F.array("a", "b")).alias("end"))
    by_estimate = Window.partitionBy("end").orderBy(F.desc("estimate"), "a", "b")
    best = ends.withColumn("place", F.row_number().over(by_estimate)).where(F.col("place") <= BEST)
    second = best.select("a", "b").union(stars.select("a", "b")).distinct().join(tried, ["a", "b"], "left_anti")
    second = stage(second, "tried")
    with arrow_batch(docs.sparkSession, SETS_AT_ONCE):
        found = stage(_linked(second, sets), "links-second")
    tried = stage(tried.union(second), "tried")
    if not found.isEmpty():
        links = stage(links.union(found), "links")
        labels = components(links)

    # Further rounds: whatever is not connected yet, until nothing is left to compare. First all
    # members outside the main component of a list ask, then those that something was withheld
    # from: all pairs of the others have been tried or lie in one component.
    partners, asks = PARTNERS, None
    while True:
        rest = _labelled(_labelled(pairs, labels, "a", "ca"), labels, "b", "cb").where("ca <> cb").select("a", "b")
        parts = _labelled(crowded, labels, "cid", "component")
        counted = parts.groupBy("v", "component").agg(F.count("*").alias("n"))
        mains = counted.groupBy("v").agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts")
        )
        open_ = parts.join(mains.where("parts > 1"), "v")
        if asks is None:
            open_ = open_.withColumn("ask", F.col("component") != F.col("largest"))
        else:
            open_ = open_.join(asks.select("v").distinct(), "v", "left_semi")
            open_ = open_.join(asks.withColumn("ask", F.lit(True)), ["v", "cid"], "left")
            open_ = open_.withColumn("ask", F.coalesce("ask", F.lit(False)))
        still = stage(open_.drop("largest", "parts", "n_long").join(wide, "cid"), "crowded-open")
        found = stage(_block_pairs(still, partners), "crowded-pairs")
        more = rest.union(found.select("a", "b")).distinct()
        more = stage(more.join(tried, ["a", "b"], "left_anti"), "more")
        with arrow_batch(docs.sparkSession, SETS_AT_ONCE):
            new = stage(_linked(more, sets), "links-more")
        tried = stage(tried.union(more), "tried")
        if not new.isEmpty():
            links = stage(links.union(new), "links")
            labels = components(links)
        asks = stage(found.where("withheld").select("v", "cid").distinct(), "crowded-asks")
        if asks.isEmpty():
            # Short lists have no pair left that was not tried.
            break
        if new.isEmpty():
            partners *= 8

    named = _labelled(classes, labels, "cid", "component").select("class_key", "doc_id", "component")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups = named.join(least, "component").select(F.col("class_key").alias("key"), "component_id")
    return (
        read.join(groups, F.col("class_key") == F.col("key"), "left")
        .withColumn(
            "component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of one row of each group of near copies; rows without words all stay.

    The row that stays is that with the smallest doc_id, nulls last; of equal ones the first
    as the rows are numbered here. Rows are told apart by that number, so others that share a
    doc_id with a copy stay, repeated rows leave one, and an empty table stays empty.
    """
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    named = rows.select(F.col(row).alias("_row"), F.col("doc_id").alias("_id")).join(
        groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "_row"
    )
    order = F.struct(F.col("_id").isNull(), "_id", "_row")
    stays = named.groupBy("_group").agg(F.min(order)["_row"].alias("_stays"))
    gone = stage(named.join(stays, "_group").where("_row <> _stays").select(F.col("_row").alias(row)), "gone")
    few = gone.count() <= BROADCAST_CLASSES
    return rows.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*docs.columns)
