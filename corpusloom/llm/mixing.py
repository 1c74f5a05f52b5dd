"""A mix of sources at target weights, in blocks drawn for every output shard.

The words of a source form one stream in pseudorandom order of its documents and
are cut into blocks of fixed length. Output shards have a fixed number of slots;
the source of every slot is a multinomial draw, and draws beyond a source's quota
are given to sources that fell short, so that totals are met. The slots of a source
are numbered through all shards and mapped to block indexes by a permutation of
the block numbers of its own for every pass over the source; blocks are then joined
by their index. Everything is column expressions, joins and windows.

The short last block of a stream comes at the end of every pass, and the last slot
of a source takes only the words still due, so a source gives its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.ordering import in_order, running_totals
from corpusloom.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
ROUNDS = 24
TASK_SLOTS = 1_000_000
SEED = 20_240_601


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``sid, source, source_size, weight, target``.

    ``sizes`` is ``(source, size)``. Weights repeat over the sources by code point,
    null last. A target stops at ``most`` times the source's size; what is above goes
    to the others by weight until none is above. Taken in order of the level at which
    a source stops, the sources below the final level are the first ones, so the level
    follows from sums and needs no repetition. This is one row per source throughout.
    """
    given = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(given, (F.col("sid") % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * most)
        .withColumn("due", F.sum("source_size").over(everything) * share)
    )
    rising = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    from_here = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("due") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum(
        "weight"
    ).over(from_here)
    levels = named.withColumn("level", level).withColumn(
        "found", F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    )
    # The first valid level counts; rounding may leave none at the very top.
    lowest = F.min(F.struct(F.col("found").isNull(), F.col("most") / F.col("weight"), "sid", "found"))
    return levels.withColumn("final", lowest.over(everything)["found"]).select(
        "sid",
        "source",
        "source_size",
        "weight",
        F.coalesce(F.least("most", F.col("final") * F.col("weight")), F.col("most")).alias("target"),
    )


def quotas(wanted: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks and slots of every source.

    ``full`` blocks of fixed length and perhaps a short one make ``blocks``; the
    source has ``slots``, the last of which takes ``last_words``.
    """
    b = block_words
    return wanted.selectExpr(
        "*",
        "cast(round(target) AS bigint) AS words",
        f"source_size div {b} AS full",
        f"source_size % {b} AS rest",
        f"(source_size + {b - 1}) div {b} AS blocks",
    ).selectExpr(
        "*",
        "coalesce(words div nullif(source_size, 0), 0) AS passes",
        "coalesce(words % nullif(source_size, 0), 0) AS over",
    ).selectExpr(
        "*",
        f"CASE WHEN over <= full * {b} THEN (over + {b - 1}) div {b} ELSE full + 1 END AS part_slots",
    ).selectExpr(
        "sid", "source", "source_size", "target", "full", "rest", "blocks",
        "passes * blocks + part_slots AS slots",
        f"CASE WHEN part_slots = 0 THEN NULL WHEN part_slots <= full "
        f"THEN over - (part_slots - 1) * {b} ELSE over - full * {b} END AS last_words",
    )


def draw_counts(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """Slots per shard and source as ``(shard, sid, n)``, and every source's slots in all.

    ``sources`` is a stored ``(sid, slots)``. Every slot draws a source in proportion
    to ``slots``. A source keeps its draws up to its quota, taking shards in an order
    of its own; the slots that become free go to the sources that fell short.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots").alias("slots"), F.count("*").alias("n")).first()
    slots = int(total["slots"] or 0)
    # Draws find their source by the equal-width bin of the total that they fall in.
    width = max(1, -(-slots // max(1024, 4 * total["n"])))
    upto = F.sum("slots").over(Window.orderBy("sid"))
    spans = (
        sources.where("slots > 0")
        .withColumn("upto", upto)
        .withColumn("lo", F.col("upto") - F.col("slots"))
        .selectExpr("sid", "lo", "upto", f"explode(sequence(lo div {width}, (upto - 1) div {width})) AS bin")
    )
    draws = spark.range(slots).select(
        F.expr(f"id div {shard_slots}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, slots))).alias("u"),
    )
    drawn = (
        draws.withColumn("bin", F.expr(f"u div {width}"))
        .join(spans, "bin")
        .where("u >= lo AND u < upto")
        .groupBy("shard", "sid")
        .agg(F.count("*").alias("n"))
    )
    drawn = stage(drawn, "mix-draws")
    own_order = in_order(drawn, "sid", F.xxhash64(F.lit(seed), "sid", "shard"), "shard", label="mix-own")
    kept = (
        running_totals(own_order, "sid", "n")
        .join(sources.select("sid", "slots"), "sid")
        .selectExpr("shard", "sid", "n", "least(n, greatest(0, slots - _start)) AS kept")
    )
    kept = stage(kept, "mix-kept")

    def units(counts: DataFrame, name: str) -> DataFrame:
        """One numbered row per unit of a count; there are few of them."""
        ordered = in_order(counts.withColumn("all", F.lit(0)), name, label="mix-units")
        numbered = running_totals(ordered, "all", "units")
        return numbered.selectExpr(name, "explode(sequence(_start, _start + units - 1)) AS unit")

    free = kept.groupBy("shard").agg(F.sum(F.expr("n - kept")).alias("units")).where("units > 0")
    short = (
        sources.select("sid", "slots")
        .join(kept.groupBy("sid").agg(F.sum("kept").alias("kept")), "sid", "left")
        .selectExpr("sid", "slots - coalesce(kept, 0) AS units")
        .where("units > 0")
    )
    given = units(free, "shard").join(units(short, "sid"), "unit").selectExpr("shard", "sid", "1L AS kept")
    return (
        kept.select("shard", "sid", "kept")
        .unionByName(given)
        .groupBy("shard", "sid")
        .agg(F.sum("kept").alias("n"))
        .where("n > 0")
    )


def permuted(x: Column, n: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. n-1 at x, one for every key.

    Each round pairs x with its mirror image about a keyed point and swaps the two or
    not, by a keyed bit of the pair; that is a bijection for every n.
    """

    def step(seen: Column, turn: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, turn), n) - seen, n)
        bit = F.xxhash64(*key, turn, F.greatest(seen, mirror)).bitwiseAND(1)
        return F.when(bit == 1, mirror).otherwise(seen)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), x.cast("long"), step)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of all documents ``(doc_id, text, source)`` as three stored tables.

    Rows ``(row, doc_id, sid, size)``, one per document; sources, one per source; and
    pieces ``(row, shard, pass, block, first_word, words)``: the words of a document
    that a slot of a shard takes. A null text has no words, a null source is a source,
    repeated rows are documents of their own, documents with a null doc_id count like
    others, of other columns only those in ``carry`` are read, and go into the rows, and an empty table gives empty results. The
    draw depends on the documents and the seed only, so reruns agree.
    """
    narrow = stage(
        docs.select(
            "doc_id",
            "source",
            *carry,
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    sources = stage(quotas(targets(narrow, weights, share, most), block_words), "mix-sources")
    known = sources.select(F.col("source").alias("name"), "sid")
    known = narrow.join(known, narrow["source"].eqNullSafe(known["name"])).select("sid", "doc_id", "size", *carry)
    shuffled = F.xxhash64(F.lit(seed), "doc_id")
    # Distinct documents differ in one of these, so equal rows only have equal places.
    ordered = in_order(known, "sid", shuffled, "doc_id", "size", label="mix-order")
    placed = running_totals(ordered, "sid", "size").select(
        F.shiftleft("_part", 33).bitwiseOR(F.col("_pos")).alias("row"),
        "doc_id",
        "sid",
        "size",
        *carry,
        F.col("_start").alias("start"),
    )
    placed = stage(placed, "mix-rows")

    # Numbers of slots run over ranges of shards, and a source's shards are dealt out before
    # its slots are written out, so that those of a hot source are the work of all tasks.
    counts = draw_counts(sources.select("sid", "slots"), shard_slots, seed)
    numbered = running_totals(in_order(counts, "sid", "shard", label="mix-counts"), "sid", "n")
    wanted = sources.agg(F.sum("slots").alias("slots")).first()["slots"] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-wanted // TASK_SLOTS))
    slots = (
        numbered.join(sources.drop("source", "source_size", "target"), "sid")
        .repartition(tasks, "sid", "shard")
        .selectExpr("*", "explode(sequence(_start, _start + n - 1)) AS slot")
        .selectExpr("*", "slot div blocks AS pass", "slot % blocks AS step")
        .withColumn(
            "block",
            F.when(
                F.col("step") < F.col("full"),
                permuted(F.col("step"), F.col("full"), [F.lit(seed), F.col("sid"), F.col("pass")]),
            ).otherwise(F.col("full")),
        )
        .selectExpr(
            "sid", "shard", "slot", "pass", "block",
            "CASE WHEN slot = slots - 1 AND last_words IS NOT NULL THEN last_words "
            f"WHEN step = full THEN rest ELSE {block_words}L END AS take",
        )
    )
    b = block_words
    cut = (
        placed.where("size > 0")
        .selectExpr(
            "row", "sid", "start", "start + size AS past",
            f"explode(sequence(start div {b}, (start + size - 1) div {b})) AS block",
        )
        .selectExpr(
            "row", "sid", "block",
            f"greatest(start, block * {b}) - block * {b} AS lo",
            f"least(past, (block + 1) * {b}) - block * {b} AS hi",
            f"greatest(start, block * {b}) - start AS first_word",
        )
    )
    # Slots are many rows out of few counts, whose size would let them be broadcast.
    pieces = (
        cut.join(slots.hint("merge"), ["sid", "block"])
        .where("take > lo")
        .selectExpr(
            "row", "shard", "pass", "block", "first_word", "least(hi, take) - lo AS words"
        )
    )
    return placed.drop("start"), sources, pieces


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted."""
    rows, sources, pieces = mix(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return (
        rows.join(taken, "row", "left")
        .join(sources.select("sid", "source_size", "target"), "sid")
        .selectExpr(
            "doc_id", "size", "source_size", "target", "coalesce(taken, 0L) AS taken"
        )
    )


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix passes over them, with the words it takes.

    A pass that takes all words of a document gives its whole text; otherwise the text is
    cut to the ranges taken, each range with the white space after its words. Rows of which
    nothing is taken, such as those without words, are left out. The table is stored once
    with a key of its own for every row, so repeated rows stay apart.
    """
    keyed = stage(docs.withColumn("__mix_key", F.monotonically_increasing_id()), "mix-keyed")
    rows, _, pieces = mix(keyed, carry=("__mix_key",), **options)
    taken = (
        pieces.join(rows.select("row", "__mix_key", "size"), "row")
        .groupBy("__mix_key", "size", "pass")
        .agg(
            F.sum("words").alias("words"),
            F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("ranges"),
        )
        .selectExpr("__mix_key", "CASE WHEN words < size THEN ranges END AS __mix_ranges")
    )
    parts = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(
        F.transform(
            "__mix_ranges",
            lambda r: F.array_join(
                F.slice(parts, (r["first_word"] + 1).cast("int"), r["words"].cast("int")), ""
            ),
        ),
        "",
    )
    text = F.when(F.col("__mix_ranges").isNull(), F.col("text")).otherwise(cut)
    return keyed.join(taken, "__mix_key").withColumn("text", text).select(*docs.columns)
