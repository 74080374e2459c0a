"""Mixing sources to target weights, by block.

The words of each source, documents in a hashed order, are cut into blocks of a fixed
length. Output shards of a fixed number of slots draw how many slots each source gets.
A source's slots, counted through all shards, run through pseudorandom permutations of
its block numbers, one permutation per pass, and are joined with the blocks by number.
Permutations come before repeats: no block is used twice before all are used once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import count_words, let, running_total, stored, words

#: Words per block and slots per output shard.
BLOCK = 64
SHARD = 1024
#: Slots of one task, about.
SLOT_ROWS = 100_000
#: Cells of the unit interval by which a draw finds its source.
CELLS = 4096
#: Documents over this part of the words still wanted of their source come first.
LARGE = 40
#: Fixed primes for index permutations; a block count can't be divisible by all of them.
PRIMES = (1_000_000_007, 1_000_000_009, 1_000_000_021, 1_000_000_033)


def source_targets(sized: DataFrame, source: str, size: str, cycle: int = 3, cap: float = 3.0) -> DataFrame:
    """One row per source: source_no, source_size, target.

    Sources in code-point order, null last, weigh 1, 2, .. ``cycle``, repeating. Targets
    share all sizes by weight, stop at ``cap`` times the source's size, and what is over
    goes to the others by weight until none is above. That is target = least(cap * size,
    level * weight) with one level; it is found from running sums over the sources in the
    order in which they reach their cap.
    """
    sources = sized.groupBy(source).agg(F.sum(size).alias("source_size"))
    everything = Window.partitionBy()
    order = Window.partitionBy().orderBy(F.col(source).asc_nulls_last())
    sources = sources.withColumn("source_no", F.row_number().over(order)).withColumn(
        "weight", F.pmod(F.col("source_no") - 1, F.lit(cycle)) + 1
    )
    capped = F.col("source_size") * F.lit(float(cap))
    ratio = capped / F.col("weight")
    by_ratio = Window.partitionBy().orderBy(ratio, "source_no")
    before = F.coalesce(F.sum(capped).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumns(
        {"_ratio": ratio, "_level": (F.sum("source_size").over(everything) - before) / rest}
    )
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything)
    return sources.select(
        source,
        "source_no",
        "source_size",
        F.least(capped, F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def _uniform(*parts: Column) -> Column:
    """In [0, 1), from the hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _chosen(slots: DataFrame, parts: DataFrame) -> DataFrame:
    """Slots (shard, u) with the source whose part [lo, hi) of the unit interval has u,
    counted by shard and source: shard, source_no, n_blocks, n."""
    cell = lambda c: F.least(F.floor(F.col(c) * CELLS), F.lit(CELLS - 1))
    parts = parts.withColumn("cell", F.explode(F.sequence(cell("lo"), cell("hi"))))
    return (
        slots.withColumn("cell", cell("u"))
        .join(parts, "cell")
        .where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
        .groupBy("shard", "source_no", "n_blocks")
        .agg(F.count("*").alias("n"))
    )


def _numbers(spark, n: int) -> DataFrame:
    return spark.range(0, n, 1, max(8, -(-n // 500_000)))


def settled_slots(slots: int, least: float, shard: int = SHARD) -> int:
    """How many slots, those of the last shards, are kept for what draws leave of targets.

    Four standard deviations of the count of the smallest source, whose share is ``least``,
    out of its part of these slots: a part of all slots that shrinks as they grow.
    """
    wanted = min(slots, math.ceil(4 * math.sqrt(slots / max(least, 1e-12))))
    return slots - (slots - wanted) // shard * shard


def shard_counts(sources: DataFrame, slots: int, least: float, seed: int, shard: int = SHARD) -> DataFrame:
    """Source counts per output shard: shard, source_no, n_blocks, n.

    ``sources``: source_no, n_blocks, lo, hi (its part of the unit interval). Every slot of
    a shard draws its source by itself, so a shard's counts are multinomial. The slots of
    the last shards (`settled_slots`) go to the sources that the draws left short, in a
    pseudorandom order, so that every source ends with its share of all slots, rounded.
    """
    spark = sources.sparkSession
    settled = settled_slots(slots, least, shard)
    drawn = _numbers(spark, slots - settled).select(F.floor(F.col("id") / shard).alias("shard"), F.pmod("id", F.lit(shard)).alias("slot"))
    drawn = drawn.select("shard", _uniform(F.lit(seed), F.col("shard"), F.col("slot")).alias("u"))
    counts = stored(_chosen(drawn, sources), "mix-drawn")
    had = counts.groupBy("source_no").agg(F.sum("n").alias("had"))
    quota = F.floor(F.least(F.col("hi"), F.lit(1.0)) * slots) - F.floor(F.col("lo") * slots)
    short = F.greatest(quota - F.coalesce("had", F.lit(0)), F.lit(0))
    by_no = Window.partitionBy().orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    left = sources.join(had, "source_no", "left").select("source_no", "n_blocks", short.alias("short"))
    left = left.withColumn("before", F.coalesce(F.sum("short").over(by_no), F.lit(0)))
    left = stored(left.where(F.col("short") > 0), "mix-left")
    total = left.agg(F.sum("short")).first()[0] or 0
    parts = left.select(
        "source_no", "n_blocks", (F.col("before") / F.lit(max(total, 1))).alias("lo"),
        ((F.col("before") + F.col("short")) / F.lit(max(total, 1))).alias("hi"),
    )
    spot = permuted(F.lit(-1), F.lit(0), F.col("id"), F.lit(max(total, 1)).cast("long"), seed)
    last = _numbers(spark, total).select(
        (F.floor(F.col("id") / shard) + (slots - settled) // shard).alias("shard"), ((spot + 0.5) / F.lit(max(total, 1))).alias("u")
    )
    return counts.unionByName(_chosen(last, parts))


def permuted(source_no: Column, turn: Column, index: Column, n: Column, seed: int) -> Column:
    """index -> (a * index + b) mod n: a is a prime that doesn't divide n, a and b are
    picked by the hash of source and turn."""
    first = F.xxhash64(F.lit(seed), source_no, turn)
    primes = F.array(*map(F.lit, PRIMES))
    tried = [
        F.element_at(primes, (F.pmod(first + k, F.lit(len(PRIMES))) + 1).cast("int"))
        for k in range(len(PRIMES))
    ]
    a = F.coalesce(*[F.when(F.pmod(n, q) != 0, q) for q in tried])
    b = F.pmod(F.xxhash64(F.lit(seed + 1), source_no, turn), n)
    big = "decimal(20,0)"  # a * index can pass 2^63
    return F.pmod(a.cast(big) * index.cast(big) + b.cast(big), n.cast(big)).cast("long")


def draws(targets: DataFrame, cap: int, seed: int, shard: int = SHARD) -> DataFrame:
    """The block that each slot takes: shard, slot, source_no, block.

    ``targets``: source_no, source_size, target, n_blocks. A source's expected number of
    slots is its target over its mean block length.
    """
    held = targets.where(F.col("n_blocks") > 0).withColumn(
        "slots", F.col("target") * F.col("n_blocks") / F.col("source_size")
    )
    sums = held.agg(F.sum("slots").alias("total"), F.min("slots").alias("least")).first()
    total, least = float(sums["total"] or 0.0), float(sums["least"] or 0.0)
    by_no = Window.partitionBy().orderBy("source_no")
    parts = held.select(
        "source_no",
        "n_blocks",
        (F.coalesce(F.sum("slots").over(by_no.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
         / F.lit(total or 1.0)).alias("lo"),
        # The last source ends above 1, so that rounding leaves no gap.
        F.when(F.lead("source_no").over(by_no).isNull(), F.lit(2.0))
        .otherwise(F.sum("slots").over(by_no) / F.lit(total or 1.0))
        .alias("hi"),
    )
    run = max(1, math.isqrt(round(total) // shard))  # shards per bucket of the running totals
    counts = shard_counts(parts, round(total), least / (total or 1.0), seed, shard).withColumn("bucket", F.floor(F.col("shard") / run))
    # A shard's slots go to its sources in their order; one row a source.
    in_shard = Window.partitionBy("shard").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("at", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
    numbered = running_total(counts, ["source_no"], "bucket", ["shard"], "n", "first")
    # Dealt by shard before they become slots, which are many more rows.
    dealt = numbered.repartition(max(1, -(-round(total) // SLOT_ROWS)), "shard")
    slots = dealt.select(
        "shard", "at", "first", "source_no", "n_blocks",
        F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("k"),
    )
    turn = F.floor(F.col("k") / F.col("n_blocks"))
    index = F.pmod("k", F.col("n_blocks"))
    return slots.where(turn < cap).select(
        "shard",
        (F.col("at") + F.col("k") - F.col("first")).alias("slot"),
        "source_no",
        permuted(F.col("source_no"), turn, index, F.col("n_blocks"), seed).alias("block"),
    )


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    cycle: int = 3,
    cap: int = 3,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """Rows doc_id, size, source_size, target, taken, one for each row of ``docs``.

    ``size`` is the row's number of words (null counts as 0). ``taken`` is how many of its
    words the mix takes, repeats counted; at most ``cap`` times its size, as a block is in
    each of ``cap`` passes once. A slot that finds its source used up ``cap`` times stays
    empty. Rows without words get 0. A null source is a source of its own; a null id is an
    id like any other, and repeated rows are packed one after the other. An empty table
    gives an empty table. Other columns of ``docs`` are not read.
    """
    rows, slots = _slotted(docs, doc_id, source, size, cycle, cap, block, seed)
    taken = slots.groupBy("source_no", "start", "doc_id", "size", "source_size", "target").agg(
        F.sum(F.when(F.col("slot").isNotNull(), F.col("n")).otherwise(0)).alias("taken")
    )
    columns = ["doc_id", "size", "source_size", "target"]
    return taken.select(*columns, "taken").unionByName(
        rows.where(F.col("size") == 0).select(*columns, F.lit(0).cast("long").alias("taken"))
    )


def _slotted(docs, doc_id, source, size, cycle, cap, block, seed) -> tuple[DataFrame, DataFrame]:
    """All rows with their sources' targets, and a row for each document's part of a block
    and each slot that takes the block; shard and slot are null where none does."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
    )
    sized = stored(sized.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "source")), "mix-sizes")
    targets = source_targets(sized, "source", "size", cycle, cap)
    targets = targets.withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
    targets = stored(targets, "mix-targets")
    buckets = max(1, math.isqrt(sized.count()))  # as many buckets as rows in each
    known = targets.withColumnRenamed("source", "_source")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    held = rows.where(F.col("size") > 0).withColumn("bucket", F.pmod("order", F.lit(buckets)))
    held = running_total(held, ["source_no"], "bucket", ["order", "doc_id", "size"], "size", "start")

    # A document's blocks and how many of its words lie in each.
    end = F.col("start") + F.col("size")
    spread = held.select(
        "doc_id", "size", "source_size", "target", "source_no", "start",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block"),
    )
    first = F.greatest(F.col("start"), F.col("block") * block)
    inside = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - first
    spread = spread.withColumns({
        "n": inside, "in_doc": first - F.col("start"), "in_block": first - F.col("block") * block
    })
    # Slots come from a small table of counts, so the planner takes them for few.
    return rows, spread.join(draws(targets, cap, seed).hint("merge"), ["source_no", "block"], "left")


def mixed_blocks(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", cycle: int = 3,
    cap: int = 3, block: int = BLOCK, seed: int = 17,
) -> DataFrame:
    """The mix itself: shard, slot, source_no, block, words, one row for each filled slot.

    The words of a block are those of the documents it runs through, in their order; the
    last block of a source can be shorter. Counted by document they are what mix_sources
    says of the same keys.
    """
    row = docs.select(
        F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("hash")).alias("key"),
        F.col(source).alias("source"),
        F.col(text).alias("text"),
        count_words(F.col(text)).alias("size"),
    )
    _, slots = _slotted(row.drop("text"), "key", "source", "size", cycle, cap, block, seed)
    # A block lies in one source, and rows that repeat id and text have the same words.
    place = F.struct("shard", "slot", "source_no", "block", "in_block", "in_doc", "n")
    parts = slots.where(F.col("slot").isNotNull()).groupBy("doc_id").agg(F.collect_list(place).alias("parts"))
    parts = parts.select("parts", F.col("doc_id.id").alias("_id"), F.col("doc_id.hash").alias("_hash"))
    texts = row.select("key", "text").dropDuplicates(["key"])
    same = F.col("key.id").eqNullSafe(F.col("_id")) & (F.col("key.hash") == F.col("_hash"))
    cut = let(words(F.col("text")), lambda ws: F.transform("parts", lambda p: p.withField(
        "words", F.slice(ws, (p["in_doc"] + 1).cast("int"), p["n"].cast("int"))
    )))
    pieces = texts.join(parts, same).select(F.inline(cut))
    piece = F.struct("in_block", "words")
    return pieces.groupBy("shard", "slot", "source_no", "block").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["words"])).alias("words")
    )


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 17, **options
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does, columns as they are.

    A source gives about as many words as `mix_sources` takes of it, in whole documents:
    all of them as often as the words suffice, then one more copy of some. Of documents
    over 1 / LARGE of the words still wanted each is drawn with its source's share, by
    hash, and those come first; short ones fill up what is left in a hashed order, and
    where they don't suffice the other long ones do, shorter ones first. Rows
    without words are not taken, null sources are a source, null ids are ids like others;
    rows that repeat id and text are taken alike. An empty table gives an empty table.
    """
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("hash")).alias("key"),
        F.col(source).alias("source"),
        count_words(F.col(text)).alias("size"),
    )
    named = {"cycle": 3, "cap": 3, "block": BLOCK, "seed": seed, **options}
    _, slots = _slotted(row.drop("row"), "key", "source", "size", **named)
    slots = stored(slots.select("doc_id", "size", "source_size", "source_no", "start", "slot", "n"), "mix-slots")
    taken = slots.where(F.col("slot").isNotNull()).groupBy("source_no").agg(F.sum("n").alias("words"))
    held = slots.select("doc_id", "size", "source_size", "source_no", "start").distinct().join(taken, "source_no")
    wanted = F.col("words") % F.col("source_size")
    drawn = _uniform(F.lit(seed + 2), F.col("doc_id")) * F.col("source_size") < wanted
    # Long documents that are drawn, then the short ones, then other long ones by length.
    short = F.col("size") * LARGE <= wanted
    buckets = max(1, math.isqrt(held.count()))
    mixed = F.xxhash64(F.lit(seed + 3), F.col("doc_id"))
    hashed = F.when(short, buckets).otherwise(0) + F.pmod(mixed, F.lit(buckets))
    by_hash = short | drawn
    held = held.withColumns({
        "order": F.when(by_hash, mixed).otherwise(F.col("size")),
        "bucket": F.when(by_hash, hashed).otherwise(2 * buckets + F.floor(F.log2("size"))),
    })
    held = running_total(held, ["source_no"], "bucket", ["order", "doc_id", "start"], "size", "before")
    more = (F.col("before") + F.col("size") / 2 <= wanted).cast("int")
    times = F.floor(F.col("words") / F.col("source_size")) + more
    placed = held.select(F.col("doc_id.id").alias("_id"), F.col("doc_id.hash").alias("_hash"), times.cast("int").alias("times"))
    placed = placed.groupBy("_id", "_hash").agg(F.max("times").alias("times")).where(F.col("times") > 0)
    same = F.col("key.id").eqNullSafe(F.col("_id")) & (F.col("key.hash") == F.col("_hash"))
    return (
        row.join(placed, same)
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy"))
        .select("row.*")
    )
