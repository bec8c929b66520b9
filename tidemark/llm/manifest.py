"""Merkle manifest of a dataset as a persistent tree: versions copy paths, everything else is shared.

Every row is a leaf. The leaves of a group (a source) stand in order; runs of `FAN` nodes
become their hash, level by level, until one node is left, the subroot. The subroots, in
order of their groups, become the root in the same way.

The tree is kept in tiers of blocks. A block holds an aligned stretch of FAN**DEPTH nodes of
one group, so it has DEPTH levels of its own and nothing outside it takes part in them. Tier 0
has the leaves, the next tier has the tops of its blocks, until every group is one block; then
the tops of the groups are the nodes of one more group, tiers and all. A hot group is as many
blocks as it has stretches: no task holds more than one block, and the tier above is smaller
by a factor of FAN**DEPTH.

A version is what the tree becomes when one leaf is replaced. It copies the leaf and its
ancestors and shares every other node. A block makes the copies of its own levels. The upper
levels go on distributed: each block is told the untouched neighbours along the way from its
top to the root (a few kilobytes, whatever the size of the data), found by going down the
tiers once, and every version of its leaves continues along them in the same task. So versions
are never gathered above, even if every leaf has one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import Scratch

FAN = 16
"""Nodes of a run."""

DEPTH = 3
"""Levels of a block."""

COPIES = "aggregate(way, array(x.changed), (path, s) -> array_append(path, sha2(cast(concat(s.before, path[size(path) - 1], s.after) AS binary), 256)))"
PROOF = "sha2(cast(array_join(transform(way, s -> concat(s.before, s.after)), '') AS binary), 256)"


def steps(depth: int) -> str:
    """The way of entry `i` of a block upwards: in every run, the neighbours left and right of it, hashes joined."""
    at = f"(i div element_at(array({', '.join(f'{FAN**r}L' for r in range(depth))}), r + 1))"
    return f"""transform(levels, (level, r) -> named_struct(
 'before', array_join(slice(level, int({at} div {FAN} * {FAN}) + 1, int({at} % {FAN})), ''),
 'after', array_join(slice(level, int({at}) + 2, {FAN - 1} - int({at} % {FAN})), '')))"""


def digest(*parts: Column) -> Column:
    """Lowercase-hex sha256 of values, each `-` if null, else its UTF-8 byte count, `:`, and itself."""
    texts = [p.cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """A tree and its versions.

    `rows`: the columns asked for, `leaf`, `subroot`, `root`, `proof_sha256` (of the neighbours from the
    leaf to the root) and `copies`: the new leaf and its copied ancestors, the last being the root of
    the version. `tiers`: the blocks, lowest first. `root`: None for an empty table.
    """

    rows: DataFrame
    tiers: list[DataFrame]
    root: str | None
    depth: int

    def nodes(self) -> DataFrame:
        """Every node of the untouched tree up to the subroots: group, level, index, hash; level 0 has the leaves."""
        parts = []
        for t, tier in enumerate(self.tiers):
            for rise in range(self.depth + 1):
                # The top of a block that is not the whole group is a node of the tier above.
                held = tier.where((F.size("nodes") > rise) & (F.col("single") | (rise < self.depth)))
                first = F.col("block") * FAN ** (self.depth - rise)
                placed = held.select("group", first.alias("first"), F.posexplode(F.col("nodes")[rise]).alias("at", "hash"))
                parts.append(placed.select(_named("group"), F.lit(t * self.depth + rise).alias("level"), (F.col("first") + F.col("at")).alias("index"), "hash"))
        return reduce(DataFrame.unionByName, parts)


def built(docs: DataFrame, group: Column, order: Column, leaf: Column, changed: Column, keep: dict[str, Column], depth: int = DEPTH) -> Manifest:
    """The manifest of `docs`, and a version for every row: `leaf` replaced by `changed`.

    `changed` is null or equal to `leaf` where nothing was changed; the version then repeats the
    path of the untouched tree. `keep` names the columns to carry along; other columns of the table
    are not read, so their names cannot clash. Groups are ordered with null first, then by UTF-8
    bytes; null is a group of its own and differs from the empty text. Inside a group rows ascend
    by `order`, null first, then by leaf; rows that repeat both are nodes of their own, and their
    order changes no hash. The leaf of a group with one row is its subroot, the subroot of the only
    group is the root, and an empty table has no rows and the root None. Leaves are taken by Spark
    in one pass over the table, however long texts are; what follows handles hashes only.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    carried = {f"k{i}": column for i, column in enumerate(keep.values())}
    key = F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))
    leaves, path = scratch.keep(
        docs.select(key.alias("group"), order.alias("rank"), leaf.alias("leaf"), F.coalesce(changed, leaf).alias("changed"), *[c.alias(n) for n, c in carried.items()])
    )
    # Equal rows are told apart by their place in the written table, so that even a million copies are split.
    ties = leaves.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("tie"))
    tiers = _climbed(scratch, _numbered(scratch, ties, ["group", "rank", "leaf", "tie"], leaves.columns), ["leaf", "changed", *carried], depth)
    scratch.drop(path)
    tops, _ = scratch.keep(reduce(DataFrame.unionByName, [t.where("single").select("group", F.col("top").alias("leaf")) for t in tiers]))
    seats = tops.select(F.lit("").alias("group"), F.col("group").alias("member"), "leaf")
    uppers = _climbed(scratch, _numbered(scratch, seats, ["member"], seats.columns), ["leaf", "member"], depth)
    found = uppers[-1].select("top").collect()
    root = found[0].top if found else None
    start = docs.sparkSession.sql("SELECT '' AS group, CAST(array() AS array<struct<before: string, after: string>>) AS way")
    seated = _descended(scratch, uppers, start, depth)
    blocks = _descended(scratch, tiers, _stepped(seated, ["x.member AS group", "x.leaf AS subroot"], depth), depth)
    version = f"transform(array({COPIES}), path -> named_struct('x', x, 'copies', path, 'proof', {PROOF}))[0]"
    each = f"transform(entries, (x, i) -> transform(array(concat({steps(depth)}, way)), way -> {version})[0])"
    rows = blocks.select("subroot", F.explode(F.expr(each)).alias("v")).select(
        *[F.col(f"v.x.{n}").alias(name) for n, name in zip(carried, keep)],
        F.col("v.x.leaf").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.col("v.proof").alias("proof_sha256"),
        F.col("v.copies").alias("copies"),
    )
    return Manifest(rows, tiers, root, depth)


def _named(column: str) -> Column:
    """The group as it came in."""
    return F.expr(f"CASE WHEN `{column}` <> '' THEN substr(`{column}`, 2) END").alias(column)


def _numbered(scratch: Scratch, rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """`columns`, with `index` inside the group by `order`, and `total`, the rows of the group.

    Rows are range-partitioned and sorted as a whole, so a hot group is spread over partitions, and
    written. Each file then knows how many rows of a group it has, and the sums over the files before
    it are the offsets.
    """
    ranged = rows.repartitionByRange("group", *[c for c in order if c != "group"]).sortWithinPartitions("group", *[c for c in order if c != "group"])
    written, _ = scratch.keep(ranged.select(*columns, F.spark_partition_id().alias("part")))
    placed = written.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    runs = placed.groupBy("group", "part", "file").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    along, whole = Window.partitionBy("group").orderBy("part", "file"), Window.partitionBy("group")
    before = F.sum("n").over(along) - F.col("n") - F.col("first")
    offsets = runs.select("group", "part", "file", before.alias("offset"), F.sum("n").over(whole).alias("total"))
    return placed.join(offsets, ["group", "part", "file"]).select(*columns, (F.col("offset") + F.col("row")).alias("index"), "total")


def _climbed(scratch: Scratch, nodes: DataFrame, carried: list[str], depth: int) -> list[DataFrame]:
    """The tiers above numbered nodes, until every group is one block."""
    tiers, columns = [], carried
    while True:
        tier, _ = scratch.keep(_blocks(nodes, columns, depth))
        tiers.append(tier)
        open_ = tier.where("NOT single").select("group", F.col("block").alias("index"), F.ceil(F.col("total") / FAN**depth).alias("total"), F.col("top").alias("leaf"))
        if open_.isEmpty():
            return tiers
        nodes, columns = open_, ["leaf"]


def _blocks(nodes: DataFrame, columns: list[str], depth: int) -> DataFrame:
    """group, block, total, single, entries (the block's nodes with `columns`), nodes (hashes by level), top.

    A level is added while the group has several nodes there; a run of one is hashed like any other.
    """
    entry = F.struct("index", *columns)
    rows = nodes.groupBy("group", F.floor(F.col("index") / FAN**depth).alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.first("total").alias("total")
    )
    rows = rows.withColumn("n0", F.col("entries.leaf"))
    for r in range(depth):
        runs = f"transform(sequence(1, size(n{r}), {FAN}), a -> sha2(cast(array_join(slice(n{r}, a, {FAN}), '') AS binary), 256))"
        rows = rows.withColumn(f"n{r + 1}", F.expr(f"CASE WHEN total > {FAN**r} THEN {runs} END"))
    levels = F.filter(F.array(*[f"n{r}" for r in range(depth + 1)]), lambda level: level.isNotNull())
    return rows.select("group", "block", "total", (F.col("total") <= FAN**depth).alias("single"), "entries", levels.alias("nodes")).select(
        "*", F.element_at("nodes", -1)[0].alias("top")
    )


def _stepped(blocks: DataFrame, columns: list[str], depth: int) -> DataFrame:
    """One row per entry: `columns`, computed from entry `x` and the block, and its way to the root."""
    each = F.expr(f"transform(entries, (x, i) -> named_struct('x', x, 'way', concat({steps(depth)}, way)))")
    rows = blocks.select(*[c for c in blocks.columns if c in ("group", "block", "subroot")], F.explode(each).alias("v"))
    return rows.select("*", F.col("v.x").alias("x"), F.col("v.way").alias("way")).selectExpr(*columns, "way")


def _descended(scratch: Scratch, tiers: list[DataFrame], ways: DataFrame, depth: int) -> DataFrame:
    """The blocks of the lowest tier with `levels` and `way`: the neighbours from the block's top to the root.

    `ways` has those of the groups; a block that is not its whole group gets its way from the block above it.
    """
    extra = [c for c in ways.columns if c not in ("group", "way")]
    told = None
    for t in reversed(range(len(tiers))):
        to_groups = ways.select("group", F.lit(0).cast("long").alias("block"), F.lit(True).alias("single"), *extra, "way")
        told = to_groups if told is None else to_groups.unionByName(told)
        told, _ = scratch.keep(told)
        levels = F.expr("slice(nodes, 1, size(nodes) - 1)").alias("levels")
        blocks = tiers[t].select("group", "block", "single", "entries", levels).join(told, ["group", "block", "single"])
        if t:
            told = _stepped(blocks, ["group", "x.index AS block", "false AS single", *extra], depth)
    return blocks
