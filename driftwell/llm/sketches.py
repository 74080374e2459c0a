"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch deals digests into groups by their leading bits; a group is a small table of
cells in three parts. A digest is in one cell of each part; a cell holds a count, the xor
of its digests and the xor of their checks. Sketches of two versions subtract cell by
cell: what they share is gone, and peeling (a cell with one digest gives it away, which
empties others) recovers the digests that differ. A group that doesn't peel to nothing is
made again with twice the cells.

Everything happens in the row of its document, in DataFrame expressions; the texts are
shuffled once, to put each beside the next document's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import let

#: A line over this many characters is cut after each sentence.
LINE = 200
#: A piece still over this many characters is cut after words whose hash meets a condition
#: (one in WORDS), a word as long after characters whose neighbourhood does (one in CHARS).
PIECE = 400
WORDS, CHARS = 16, 96
#: What no hash cuts in so many characters is a few words over and over: it is cut after
#: each word, and a word of a few characters over and over at every PIECE.
MOST = 1600
#: A group is for about so many digests of one text; cells of each of its three parts.
GROUP = 6
PART = 7
#: Times that a group is made again with twice the cells.
RETRIES = 4
PEELS = 10
MOST_GROUP_BITS = 40
#: Ranges of ids that texts are put in order by.
MOST_RANGES = 4096
RANGE_ROWS = 2000


def _after_chars(word: Column) -> Column:
    """A long word with a line feed after each character whose hash with the three before
    it meets the condition."""
    marked = lambda chars: F.transform(
        chars,
        lambda x, i: F.when(
            F.pmod(F.xxhash64(F.get(chars, i - 3), F.get(chars, i - 2), F.get(chars, i - 1), x), F.lit(CHARS)) == 0,
            F.concat(x, F.lit("\n")),
        ).otherwise(x),
    )
    return let(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), lambda chars: F.array_join(marked(chars), ""))


def _by_content(piece: Column) -> Column:
    """Pieces of a long piece: where it is cut depends on the words around alone, so an
    insertion moves no cut but its own."""
    words = lambda x: F.split(x, r"(?<=[ \t])(?=[^ \t])", -1)
    marked = F.transform(
        words(piece),
        lambda w: F.when(F.length(w) > PIECE, _after_chars(w))
        .when(F.pmod(F.xxhash64(w), F.lit(WORDS)) == 0, F.concat(w, F.lit("\n")))
        .otherwise(w),
    )
    return F.flatten(
        F.transform(
            F.split(F.array_join(marked, ""), "\n", -1),
            lambda x: F.when(F.length(x) <= MOST, F.array(x)).otherwise(
                F.flatten(
                    F.transform(words(x), lambda w: F.regexp_extract_all(w, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
                )
            ),
        )
    )


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs: its lines, long ones cut after
    sentences, and after words by their hash where there are no sentences; empty ones
    don't count."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    cut = F.flatten(
        F.transform(
            lines,
            lambda x: F.when(F.length(x) <= LINE, F.array(x)).otherwise(F.split(x, r"(?<=[.!?])[ \t]+", -1)),
        )
    )
    # Few texts have a piece without sentence ends; the others are left as they are.
    long = lambda x: F.length(x) > PIECE
    cut = let(cut, lambda c: F.when(
        F.exists(c, long), F.flatten(F.transform(c, lambda x: F.when(long(x), _by_content(x)).otherwise(F.array(x))))
    ).otherwise(c))
    return F.array_distinct(F.transform(F.filter(cut, lambda x: x != ""), lambda x: F.xxhash64(x)))


def level_of(found: Column) -> Column:
    """Bits of the group number: 2 ** level groups of about GROUP digests."""
    n = F.greatest(F.size(found), F.lit(1))
    return F.least(F.greatest(F.ceil(F.log2(n / F.lit(float(GROUP)))), F.lit(0)), F.lit(MOST_GROUP_BITS)).cast("int")


def _field(d: Column, skip: Column, bits: Column) -> Column:
    """``bits`` bits of a digest after its first ``skip``; the last shift is in two parts,
    as one by 64 would be none."""
    left = F.call_function("shiftleft", d, skip)
    return F.call_function("shiftrightunsigned", F.shiftrightunsigned(left, 1), F.lit(63) - bits)


def groups(found: Column, level: Column) -> Column:
    """Array of arrays: the digests of each group. In two steps, so that a text of n
    digests takes n * sqrt(groups) looks."""
    # The numbers of bits are looked up once, not for every digest.
    bits = F.struct(F.floor(level / 2).cast("int").alias("coarse"), F.ceil(level / 2).cast("int").alias("fine"))
    return let(bits, lambda b: _grouped(found, b["coarse"], b["fine"]))


def _grouped(found: Column, coarse: Column, fine: Column) -> Column:
    count = lambda bits: F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    return F.flatten(
        F.transform(
            count(coarse),
            lambda c: let(
                F.filter(found, lambda d: _field(d, F.lit(0), coarse) == c),
                lambda part: F.transform(
                    count(fine), lambda f: F.filter(part, lambda d: _field(d, coarse, fine) == f)
                ),
            ),
        )
    )


def _placed(key: Column, count: Column, part: int, attempt: int) -> Column:
    """A digest with its check and its cell in each of the three parts."""
    h = F.xxhash64(key, F.lit(attempt))
    spot = lambda j: F.pmod(F.shiftrightunsigned(h, 21 * j), F.lit(part)).cast("int")
    return F.struct(
        count.alias("n"), key.alias("k"), F.xxhash64(key, F.lit(99)).alias("h"),
        spot(0).alias("a"), spot(1).alias("b"), spot(2).alias("c"),
    )


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.cast("long").alias("k"), h.cast("long").alias("h"))


def cells(group: Column, part: int = PART, attempt: int = 0) -> Column:
    """Sketch of one group: 3 * part cells of (n, k, h)."""
    return let(
        F.transform(group, lambda d: _placed(d, F.lit(1), part, attempt)),
        lambda items: F.concat(*[_part(items, part, j) for j in "abc"]),
    )


def _part(items: Column, part: int, j: str) -> Column:
    zero = _cell(F.lit(0), F.lit(0), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.lit(part - 1)),
        lambda i: F.aggregate(
            F.filter(items, lambda x: x[j] == i),
            zero,
            lambda acc, x: _cell(acc["n"] + 1, acc["k"].bitwiseXOR(x["k"]), acc["h"].bitwiseXOR(x["h"])),
        ),
    )


def subtract(one: Column, other: Column) -> Column:
    return F.zip_with(
        one, other,
        lambda p, q: _cell(p["n"] - q["n"], p["k"].bitwiseXOR(q["k"]), p["h"].bitwiseXOR(q["h"])),
    )


def _without(cells: Column, items: Column, j: str) -> Column:
    """One part's cells without the items."""

    def rest(c: Column, i: Column) -> Column:
        mine = F.filter(items, lambda x: x[j] == i)
        return F.aggregate(
            mine,
            c,
            lambda acc, x: _cell(acc["n"] - x["n"], acc["k"].bitwiseXOR(x["k"]), acc["h"].bitwiseXOR(x["h"])),
        )

    return F.transform(cells, rest)


def peel(sketch: Column, part: int, attempt: int) -> Column:
    """Digests that differ, as structs (k, n): n is 1 for the first text's, -1 for the
    second's. Null if the sketch doesn't peel to nothing."""
    pure = lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"], F.lit(99)) == c["h"])
    none = F.expr("cast(array() as array<struct<k: bigint, n: int>>)")
    state = lambda rest, found, done: F.struct(rest.alias("rest"), found.alias("found"), done.alias("done"))

    def once(st: Column, _: Column) -> Column:
        new = F.array_distinct(
            F.transform(F.filter(st["rest"], pure), lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n")))
        )
        # Once a round finds nothing, the rounds after it have nothing to look at.
        return F.when(st["done"], st).otherwise(let(new, lambda got: F.when(
            F.size(got) == 0, state(st["rest"], st["found"], F.lit(True))
        ).otherwise(
            let(
                F.transform(got, lambda g: _placed(g["k"], g["n"], part, attempt)),
                lambda items: state(
                    F.concat(*[_without(F.slice(st["rest"], 1 + at * part, part), items, j) for at, j in enumerate("abc")]),
                    F.concat(st["found"], got),
                    F.lit(False),
                ),
            )
        )))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(PEELS)), state(sketch, none, F.lit(False)), once)
    left = lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["h"] != 0)
    return let(end, lambda st: F.when(~F.exists(st["rest"], left), st["found"]))


def difference(one: Column, other: Column, level: Column) -> Column:
    """The digests that differ between two texts' sketches of the same level, (k, n)."""

    def solved(a: Column, b: Column) -> Column:
        tries = []
        for t in range(RETRIES + 1):
            part = PART << t
            tries.append(peel(subtract(cells(a, part, t), cells(b, part, t)), part, t))
        # Beyond the last retry, which takes about 10^-9 of luck, by comparing the digests.
        plain = F.concat(
            F.transform(F.array_except(a, b), lambda d: F.struct(d.alias("k"), F.lit(1).alias("n"))),
            F.transform(F.array_except(b, a), lambda d: F.struct(d.alias("k"), F.lit(-1).alias("n"))),
        )
        return F.coalesce(*tries, plain)

    return let(
        F.struct(groups(one, level).alias("a"), groups(other, level).alias("b")),
        lambda g: F.flatten(F.zip_with(g["a"], g["b"], solved)),
    )


def likeness(one: Column, other: Column) -> Column:
    """Shared share of all paragraphs, from the recovered difference; 1 for two texts
    without any."""
    level = F.greatest(level_of(one), level_of(other))
    mine = F.size(one)
    return let(difference(one, other, level), lambda d: let(
        F.size(F.filter(d, lambda x: x["n"] == 1)),
        lambda gone: F.when(mine + F.size(d) == 0, F.lit(1.0)).otherwise(
            (mine - gone) / (mine + F.size(d) - gone).cast("double")
        ),
    ))


def fingerprint(found: Column) -> Column:
    """Text of a sketch at its own level: the level, the number of paragraphs, and the md5
    of all its cells."""
    level = level_of(found)
    table = F.transform(groups(found, level), lambda g: cells(g))
    return F.concat_ws("-", level.cast("string"), F.size(found).cast("string"), F.md5(F.to_json(table)))


def _ranged(rows: DataFrame) -> DataFrame:
    """Adds the column range: rows in ascending id order fall in ascending ranges."""
    n, bounds = rows.count(), []
    ranges = min(MOST_RANGES, n // RANGE_ROWS)
    if ranges > 1:
        at = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", at, 10 * ranges)).first()[0] or []))
    if not bounds:
        return rows.withColumn("range", F.lit(0))
    held = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << k) for k in range(math.floor(math.log2(len(bounds))), -1, -1)])
    spot = F.aggregate(
        steps,
        F.lit(0),
        lambda lo, s: F.when(
            (lo + s <= len(bounds)) & (F.get(held, lo + s - 1) <= F.col("doc_id")), lo + s
        ).otherwise(lo),
    )
    return rows.withColumn("range", spot)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, text, next_text: the text of the next document by ascending id, after
    the last the first. Null ids come first, equal ids in the order of their texts' hash.

    Rows are put in order range by range; the first row of each range also goes to the
    range before, so that no row needs more than its own range.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    rows = _ranged(rows)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")
    heads = rows.groupBy("range").agg(F.min(order).alias("head")).orderBy("range").collect()  # one a range
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    spread = F.lit(None).cast("array<struct<range: int, last: int>>")
    here = F.struct(F.col("range").cast("int").alias("range"), F.lit(0).alias("last"))
    before = {h["range"]: heads[i - 1]["range"] for i, h in enumerate(heads)}
    size = max(before) + 1
    own = {h["range"]: h["head"] for h in heads}
    array = lambda kind, f: F.array(*[F.lit(f(r)).cast(kind) for r in range(size)])
    kind = rows.schema["doc_id"].dataType.simpleString()
    is_head = F.col("doc_id").eqNullSafe(
        F.get(array(kind, lambda r: own[r]["doc_id"] if r in own else None), F.col("range"))
    ) & (F.col("hash") == F.get(array("long", lambda r: own[r]["hash"] if r in own else None), F.col("range")))
    there = F.struct(
        F.get(array("int", before.get), F.col("range")).alias("range"), F.lit(1).alias("last")
    )
    spread = F.when(is_head, F.array(here, there)).otherwise(F.array(here))
    dealt = rows.select("doc_id", "text", "hash", F.inline(spread))
    in_range = Window.partitionBy("range").orderBy("last", F.col("doc_id").asc_nulls_first(), "hash")
    return (
        dealt.withColumn("next_text", F.lead("text").over(in_range)).where(F.col("last") == 0)
        .select("doc_id", "text", "next_text")
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, one per document.

    The edited text keeps all but the last floor(n_chars / 2) characters and goes on with
    the first as many of the next document. A null text is empty; empty texts are alike
    (1.0), and an empty and another text are not (0.0). An only document is its own next
    one. Repeated rows are documents of their own; an empty table gives an empty table;
    other columns are not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs, doc_id, text).withColumn(
        "edited", F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    )
    rows = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("new"),
        digests(F.col("next_text")).alias("next"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
