"""Merkle manifest of a dataset: a tree for each source and one over their roots.

Every RUN consecutive nodes of a level become one node, until one is left. Rows get their
place in their tree from sorted ranges. A builder takes an aligned block of LEAVES leaves
and appends nodes to its segment of the log in the order in which they are complete, so a
node stands after all nodes below it. The blocks' last nodes are the leaves of the next
tier's log, LEAVES times smaller, as long as a tree has more than one block.

A node's place in the log follows from the sizes of the subtrees before it (`position`).
Proofs are read from the segments by such places: each tier gives the siblings of one
block's leaves, and a block hands the siblings above it down to all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import stored

RUN = 16
#: Levels that a builder adds, and the leaves of its block.
HEIGHT = 2
LEAVES = RUN**HEIGHT
#: Characters of a digest.
HEX = 64
#: Rows that are sorted into one range.
RANGE_ROWS = 200_000


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def position(level: int, j: int, leaves: int) -> int:
    """Place in a tier's log of node ``j`` of a level: all nodes of the complete subtrees
    up to its last leaf, then the levels above that leaf."""
    last = min((j + 1) * RUN**level, leaves) - 1
    return sum(last // RUN**h for h in range(HEIGHT + 1)) + level


def climb(leaves: int) -> int:
    """Levels above the leaves in one tier of a tree of so many leaves."""
    levels = 0
    while leaves > 1 and levels < HEIGHT:
        levels, leaves = levels + 1, -(-leaves // RUN)
    return levels


def segment(leaves: list[str], first: int, total: int) -> list[str]:
    """Nodes over the leaves from place ``first`` on, in the order of their completion."""
    nodes, top = [], climb(total)
    waiting: list[list[str]] = [[] for _ in range(top)]
    for done, node in enumerate(leaves, first + 1):
        nodes.append(node)
        for level in range(top):
            waiting[level].append(node)
            if done % RUN ** (level + 1) and done != total:
                break
            node = digest("".join(waiting[level]))
            waiting[level] = []
            nodes.append(node)
    return nodes


def siblings(nodes: str, block: int, i: int, total: int) -> str:
    """The other nodes of the runs that lead from leaf ``i`` to its block's last node."""
    out, start, width = [], position(0, block * LEAVES, total), total
    for level in range(climb(total)):
        run = i // RUN * RUN
        for j in range(run, min(run + RUN, width)):
            if j != i:
                at = (position(level, j, total) - start) * HEX
                out.append(nodes[at : at + HEX])
        i, width = i // RUN, -(-width // RUN)
    return "".join(out)


def fold(leaf: str, path: str, *places: tuple[int, int]) -> str:
    """The root that a leaf and its siblings give; ``places``: its place and the number of
    leaves, in its own tree and then in those above."""
    at = 0
    for i, width in places:
        while width > 1:
            others = (min(RUN, width - i // RUN * RUN) - 1) * HEX
            mine = at + i % RUN * HEX
            leaf = digest(path[at:mine] + leaf + path[mine : at + others])
            at, i, width = at + others, i // RUN, -(-width // RUN)
    return leaf


def numbered(rows: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """Adds ``i``, a row's place in its tree, and ``n``, the rows of the tree.

    Rows are sorted in ranges, so a tree may spread over any number of them; only the
    ranges' counts are added up.
    """
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    rows = rows.repartitionByRange(ranges, tree, *order).sortWithinPartitions(tree, *order)
    # Of a sorted range, the number of the range and the row's place in it.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("range", F.shiftright("row", 33))
    counts = rows.groupBy(tree, "range").agg(F.count("*").alias("held"), F.min("row").alias("first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        tree,
        "range",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(whole).alias("n"),
    )
    return rows.join(counts, [tree, "range"]).withColumn("i", F.col("row") + F.col("shift")).drop("row", "range", "shift")


@dataclass(frozen=True)
class Log:
    """Segments by tier: tree, n (leaves of the tier's tree), block, start, nodes, and in
    the first tier ids and claims of the block's rows."""

    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """Rows tree, digest."""
        last = [_tops(t.where(F.col("n") <= LEAVES)) for t in self.tiers]
        out = last[0]
        for t in last[1:]:
            out = out.unionByName(t)
        return out.select("tree", "digest")


def _tops(segments: DataFrame) -> DataFrame:
    return segments.select(
        "tree", F.ceil(F.col("n") / LEAVES).alias("n"), F.col("block").alias("i"), F.expr(f"right(nodes, {HEX})").alias("digest")
    )


def append(leaves: DataFrame, most: int, label: str) -> Log:
    """Build the log over rows tree, i, n, digest, id, claim; ``most``: the largest n."""
    id_kind = leaves.schema["id"].dataType.simpleString()
    tiers, members = [], True
    while True:
        names = ["tree", "n", "i", "digest", *(["id", "claim"] if members else [])]
        rows = leaves.select(*names).withColumn("block", F.floor(F.col("i") / LEAVES))
        rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "i")
        kinds = "tree string, n long, block long, start long, nodes string"
        kinds += f", ids array<{id_kind}>, claims array<string>" if members else ""
        tiers.append(stored(rows.mapInArrow(_builder(kinds, members), kinds), f"{label}-{len(tiers)}"))
        if most <= LEAVES:
            return Log(tiers)
        leaves, most, members = _tops(tiers[-1].where(F.col("n") > LEAVES)), -(-most // LEAVES), False


def _builder(kinds: str, members: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [k.split(" ")[0] for k in kinds.split(", ")]
        out, key, held, schema = [], None, [], None

        def close() -> None:
            tree, n, block = key
            first = block * LEAVES
            row = [tree, n, block, position(0, first, n), "".join(segment([h[0] for h in held], first, n))]
            out.append([*row, *([[h[1] for h in held], [h[2] for h in held]] if members else [])])

        def rows() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(schema)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for b in batches:
            if schema is None:
                schema = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                schema += [pa.list_(b.schema.field("id").type), pa.list_(pa.string())] if members else []
            cols = [b.column(c).to_pylist() for c in ("tree", "n", "block", "digest", *(("id", "claim") if members else ()))]
            for tree, n, block, *rest in zip(*cols, strict=True):
                if (tree, n, block) != key:
                    if held:
                        close()
                    key, held = (tree, n, block), []
                held.append(rest)
            if len(out) >= 64:
                yield rows()
        if held:
            close()
        if out:
            yield rows()

    return run


def _handed_down(log: Log, tops: DataFrame, label: str) -> DataFrame:
    """Segments of the first tier with the columns of ``tops`` (tree, path and others),
    where path has grown by the siblings in the tiers above."""
    carry = [f for f in tops.schema.fields if f.name not in ("tree", "path")]
    kinds = "tree string, block long, path string" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in carry)
    below = None
    for t in range(len(log.tiers) - 1, -1, -1):
        segments = log.tiers[t]
        met = segments.where(F.col("n") <= LEAVES).join(tops, "tree")
        if below is not None:
            met = met.unionByName(segments.where(F.col("n") > LEAVES).join(below, ["tree", "block"]))
        if not t:
            return met
        below = stored(met.mapInArrow(_paths([f.name for f in carry]), kinds), f"{label}-{t}")


def _paths(carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                first, n = row["block"] * LEAVES, row["n"]
                places = range(first, min(first + LEAVES, n))
                paths = [siblings(row["nodes"], row["block"], i, n) + row["path"] for i in places]
                same = [pa.array([row[c]] * len(paths), b.schema.field(c).type) for c in carry]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(paths)), pa.array(places, pa.int64()), pa.array(paths, pa.string()), *same],
                    ["tree", "block", "path", *carry],
                )

    return run


def _proofs(id_kind: str, with_siblings: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                block, n, nodes = row["block"], row["n"], row["nodes"]
                leaves, proofs, folded, paths = [], [], [], []
                start = position(0, block * LEAVES, n)
                for i, claim in enumerate(row["claims"], block * LEAVES):
                    spot = (position(0, i, n) - start) * HEX
                    leaf, path = nodes[spot : spot + HEX], siblings(nodes, block, i, n) + row["path"]
                    leaves.append(leaf)
                    proofs.append(digest(path))
                    folded.append(fold(claim or leaf, path, (i, n), (row["place"], row["trees"])))
                    paths.append([path[k : k + HEX] for k in range(0, len(path), HEX)] if with_siblings else None)
                size = len(leaves)
                columns = [
                    b.column("ids").slice(at, 1).flatten(),
                    *(pa.array(c, pa.string()) for c in (leaves, [row["subroot"]] * size, [row["root"]] * size, proofs, folded)),
                    pa.array([row["place"]] * size, pa.int64()),
                    pa.array(range(block * LEAVES, block * LEAVES + size), pa.int64()),
                ]
                names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "tree_place", "leaf_place"]
                if with_siblings:
                    columns.append(pa.array(paths, pa.list_(pa.string())))
                    names.append("siblings")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def prove(rows: DataFrame, source: str, key: str, leaf: str, claim: str, with_siblings: bool = False) -> DataFrame:
    """Rows ``key``, leaf, subroot, root, proof_sha256, folded_root, tree_place, leaf_place
    and, on request, siblings: one for each row, with its proof from leaf to root.

    ``leaf`` is a digest in lower-case hexadecimal letters; folded_root is what the
    siblings give with the digest ``claim`` in its place (null: the leaf itself). Trees
    follow each other by source, null first, bytewise; leaves by key, null first, and equal
    keys by their digests. Repeated rows are leaves of their own. One leaf alone is its
    tree's root, one tree's root alone is the root; their proofs are empty. An empty table
    has no rows and no root. Other columns are not read.
    """
    s = F.col(source).cast("string")
    leaves = stored(
        rows.select(
            # A text that sorts like the source, with null before all others.
            F.coalesce(F.concat(F.lit("s"), s), F.lit("")).alias("tree"),
            F.col(key).alias("id"),
            F.col(leaf).alias("digest"),
            F.when(F.col(claim) != F.col(leaf), F.col(claim)).alias("claim"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "merkle-leaves",
    )
    leaves = numbered(leaves, "tree", ["id", "digest", "tie"], "merkle-sorted").drop("tie")
    log = append(leaves, leaves.agg(F.max("n")).first()[0] or 0, "merkle-log")
    trees = stored(log.roots(), "merkle-subroots").select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), "digest", F.lit(None).cast("string").alias("claim")
    )
    trees = numbered(trees, "tree", ["id"], "merkle-trees")
    count = trees.agg(F.max("n")).first()[0] or 0
    top = append(trees, count, "merkle-top")
    root = top.roots().select("tree", F.lit("").alias("path"), F.col("digest").alias("root"))
    kinds = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, tree_place long, leaf_place long"
    above = _handed_down(top, root, "merkle-top-paths").select(
        "block", "n", "nodes", "ids", "claims", "path", "root",
        F.lit("").alias("subroot"), F.lit(0).cast("long").alias("place"), F.lit(1).cast("long").alias("trees"),
    )
    above = above.mapInArrow(_proofs("string", True), kinds + ", siblings array<string>")
    above = above.select(
        F.col("id").alias("tree"), F.concat_ws("", "siblings").alias("path"), F.col("leaf").alias("subroot"), "root",
        F.col("leaf_place").alias("place"), F.lit(count).cast("long").alias("trees"),
    )
    met = _handed_down(log, stored(above, "merkle-above"), "merkle-paths")
    kind = rows.schema[key].dataType.simpleString()
    kinds = kinds.replace("id string", f"id {kind}", 1) + (", siblings array<string>" if with_siblings else "")
    return met.mapInArrow(_proofs(kind, with_siblings), kinds).withColumnRenamed("id", key)


def document_leaves(docs: DataFrame, text: Column) -> Column:
    """Digest of a document's doc_id, source, lang, n_chars and ``text``."""
    return leaf_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)
