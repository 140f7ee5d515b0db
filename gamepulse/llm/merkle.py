"""Merkle manifest of a dataset: one tree per group, one over the groups, and a proof per row.

Nodes are hex digests. The nodes of a level lie in aligned blocks of a power of the fan-out, and a block
keeps each of its levels as one string of concatenated digests: a parent is the hash of a substring of
fixed width, and the siblings of a node are the substrings to its left and right in its run. The roots
of the blocks are the nodes of the next round, until one is left. The roots of the groups are the leaves
of the upper tree. Proofs go the other way: a block's rows get the siblings above the block first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import numbered, written

HEX = 64  # characters of a digest


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields in a row, each `-` if null, else its UTF-8 byte count, `:` and its text."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give: hashed with its siblings, level by level."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digests(proof: Column) -> Column:
    """All siblings of a proof as one string of digests, left to right, level by level."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass(frozen=True)
class Shape:
    fan: int
    depth: int  # levels of a block

    @property
    def size(self) -> int:
        return self.fan ** self.depth

    def parents(self, level: Column) -> Column:
        """The next level's string: a digest per run of `fan` digests."""
        width = self.fan * HEX
        runs = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), "")

    def siblings(self, level: Column, depth: Column, place: Column) -> Column:
        """(left, right) of the node above a leaf's place, `depth` levels up, in its level's string."""
        node = F.floor(place / F.pow(F.lit(self.fan), depth)).cast("int")
        begin = node - node % self.fan
        return F.struct(
            F.substring(level, begin * HEX + 1, (node - begin) * HEX).alias("left"),
            F.substring(level, (node + 1) * HEX + 1, (begin + self.fan - node - 1) * HEX).alias("right"))

    def path(self, levels: Column, place: Column, above: Column) -> Column:
        """The siblings of a place in a block, then those above the block."""
        return F.concat(F.transform(levels, lambda level, d: self.siblings(level, d, place)), above)


def _blocks(nodes: DataFrame, shape: Shape, keep: list[str]) -> DataFrame:
    """(g, block, of, rows, levels, root) of nodes (g, rank, of, node, …): rows by place, levels but the top as strings.

    All blocks of a group with more than one are hashed up `depth` times, the last and shorter one too; a single
    block until one node is left.
    """
    row = F.struct((F.col("rank") % shape.size).cast("int").alias("place"), "node", *keep)
    grouped = nodes.groupBy("g", F.floor(F.col("rank") / shape.size).cast("long").alias("block"), "of").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    many = F.col("of") > shape.size
    step = grouped.withColumns({"levels": F.expr("cast(array() as array<string>)"), "top": F.array_join(F.transform("rows", lambda r: r["node"]), "")})
    for _ in range(shape.depth):
        more = many | (F.length("top") > HEX)
        step = step.withColumn("next", F.when(more, shape.parents(F.col("top"))).otherwise(F.col("top"))).select(
            "g", "block", "of", "rows", F.when(more, F.concat("levels", F.array("top"))).otherwise(F.col("levels")).alias("levels"), F.col("next").alias("top"))
    return step.withColumnRenamed("top", "root")


def _tree(leaves: DataFrame, shape: Shape, keep: list[str]) -> list[DataFrame]:
    """Stored blocks of every round, from nodes (g, rank, of, node, …); the last round has one block per group."""
    rounds = [written(_blocks(leaves, shape, keep), "merkle-blocks")]
    while rounds[-1].filter(F.col("of") > shape.size).limit(1).count():
        roots = rounds[-1].select("g", F.col("block").alias("rank"), F.ceil(F.col("of") / shape.size).cast("long").alias("of"), F.col("root").alias("node"))
        rounds.append(written(_blocks(roots, shape, []), "merkle-blocks"))
    return rounds


def _proofs(rounds: list[DataFrame], roots: DataFrame, shape: Shape) -> DataFrame:
    """(row, proof, others) of the first round's rows; `roots` gives (g, above, others) of each group's root."""
    others = [c for c in roots.columns if c not in ("g", "above")]
    found = rounds[-1].drop("root").join(roots, "g")
    for lower in reversed(rounds[:-1]):
        paths = F.transform("rows", lambda r: shape.path(F.col("levels"), r["place"], F.col("above")))
        nodes = found.select("g", *others, "block", F.posexplode(paths).alias("place", "above"))
        nodes = nodes.withColumn("block", F.col("block") * shape.size + F.col("place")).drop("place")
        found = lower.drop("root").join(nodes, ["g", "block"])
    rows = F.transform("rows", lambda r: F.struct(r.alias("row"), shape.path(F.col("levels"), r["place"], F.col("above")).alias("proof")))
    return found.select(*others, F.inline(rows))


def merkle_manifest(
    docs: DataFrame, fields: list[str], order_col: str = "doc_id", group_col: str = "source", keep: list[str] | None = None,
    fan: int = 3, depth: int = 6,
) -> DataFrame:
    """Per row: the order column, the `keep` columns, leaf, subroot, root and proof (an array of (left, right) strings).

    The leaf is `leaf_digest` of the fields. Leaves of one group ascend by the order column (null first; ties by
    leaf, so that equal rows are neighbours); while several nodes remain, every `fan` neighbours are hashed to
    one, the last run being shorter. What remains is the group's subroot; the subroots, ordered by group (null
    first, bytewise), give the root the same way. `fold(leaf, proof)` is the root.

    Null fields have a leaf of their own (`-`); a null group is a group; a group of one row has its leaf as
    subroot, a single group its subroot as root; repeated rows are leaves of their own; columns not named are ignored,
    so their names cannot clash; an empty table gives an empty manifest.

    A block has `fan ** depth` rows and about 150 kB; a group of any size, and any number of groups, is spread over
    blocks. Only digests and the `keep` columns are shuffled, never the fields; rows of the tables are written once
    per round, the first of which is by far the largest. The number of rounds is log(rows) to the base of a block.
    """
    shape, keep = Shape(fan, depth), keep or []
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # "-" sorts before "="
    names = [f"keep_{i}" for i in range(len(keep))]
    carried = [F.col(c).alias(n) for c, n in zip(keep, names)]
    leaves = docs.select(group.alias("g"), F.col(order_col).alias("id"), leaf_digest(*map(F.col, fields)).alias("node"), *carried)
    lower = _tree(numbered(leaves, [F.col("id"), F.col("node")], ["g"]), shape, ["id", *names])
    subroots = lower[-1].select(F.lit("").alias("all"), F.col("g").alias("name"), F.col("root").alias("subroot"))
    ranked = numbered(subroots, [F.col("name")]).select(F.col("all").alias("g"), "rank", "of", F.col("subroot").alias("node"), "name")
    upper = _tree(ranked, shape, ["name"])
    top = upper[-1].select("g", F.col("root"), F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("above"))
    heads = _proofs(upper, top, shape).select(
        F.col("row.name").alias("g"), F.col("row.node").alias("subroot"), "root", F.col("proof").alias("above"))
    rows = _proofs(lower, heads, shape)
    return rows.select(
        F.col("row.id").alias(order_col), *[F.col(f"row.{n}").alias(c) for n, c in zip(names, keep)], F.col("row.node").alias("leaf"), "subroot", "root", "proof")
