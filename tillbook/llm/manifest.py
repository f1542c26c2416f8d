"""Merkle manifest: a hash tree over each source's documents, and a tree over the sources.

Leaves are numbered within their source; a number's base-16 digits name the runs that a
leaf lies in. Blocks of 4,096 nodes (three digits) are rolled up by grouping one digit
away after another: 16 child structs become one struct with their hash and themselves
nested inside. A block's hash is a node of the next tier, which is rolled up alike until
each source has one block. All three groupings of a tier run on one exchange by (source,
block), so no group has more than 16 rows at once and no task an unbounded one.

Proofs come from the nested blocks themselves: from the top tier down, each block is
opened by transforms that put a node's siblings beside it, and exploded. What lies above a
block meets it by one more grouping on (source, block), never by a join. Texts are read
once and do not move: from the scan on there are only digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.operators.numbering import number_within
from tillbook.sources.scratch import write_scratch

#: Nodes of a run, as bits of a rank; digits that one tier groups away.
DIGIT, DIGITS = 4, 3
RUN, BLOCK = 1 << DIGIT, 1 << DIGIT * DIGITS

#: The columns that make a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A node's siblings in its run, to its left and to its right.
_STEP = "struct<left:string,right:string>"


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _told(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return _sha(*[_told(v) for v in values])


def _all(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda n: n["h"]), "")


def _roll_up(ranked: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Blocks of (grp, rank, h, payload): grp, block, size, h (the block's node), kids (nested)."""
    digit = lambda k: F.shiftright("rank", DIGIT * k).bitwiseAND(RUN - 1).cast("int")
    nodes = ranked.select(
        "grp",
        F.shiftright("rank", DIGIT * DIGITS).alias("block"),
        *[digit(k).alias(f"d{k}") for k in range(1, DIGITS)],
        F.struct(digit(0).alias("at"), "h", *payload).alias("node"),
    ).repartition("grp", "block")
    for k in range(1, DIGITS + 1):
        keys = ["grp", "block", *[f"d{i}" for i in range(k, DIGITS)]]
        nodes = nodes.groupBy(*keys).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        # With the hash in a column of its own the list is sorted once.
        nodes = nodes.withColumn("h", F.sha2(_all(F.col("kids")), 256))
        if k < DIGITS:
            rest = [f"d{i}" for i in range(k + 1, DIGITS)]
            nodes = nodes.select("grp", "block", *rest, F.struct(F.col(f"d{k}").alias("at"), "h", "kids").alias("node"))
    # A first block that is not full is all there is of its group: then only runs above several
    # nodes are hashed. Behind a first block, all digits count.
    second, third = F.col("kids"), F.col("kids")[0]["kids"]
    several = [F.size(second) > 1, F.size(third) > 1, F.size(third[0]["kids"]) > 1]
    levels = (
        F.when((F.col("block") > 0) | several[0], 3).when(several[1], 2).when(several[2], 1).otherwise(0)
    )
    lone = third[0]["kids"][0]["h"]
    node = F.when(F.col("levels") == 3, F.col("h")).when(F.col("levels") == 2, second[0]["h"])
    node = node.when(F.col("levels") == 1, third[0]["h"]).otherwise(lone)
    return nodes.withColumn("levels", levels).select("grp", "block", "levels", node.alias("h"), "kids")


def _tiers(ranked: DataFrame, payload: Sequence[str]) -> list[DataFrame]:
    """Blocks of leaves, blocks of blocks, and so on until each group has one block.

    Each tier is written to the shared scratch folder: it is read going up and down.
    """
    tiers = []
    while True:
        blocks = write_scratch(_roll_up(ranked, payload))
        tiers.append(blocks)
        if not blocks.agg(F.max("block")).first()[0]:
            return tiers
        ranked, payload = blocks.select("grp", F.col("block").alias("rank"), "h"), ()


def _paired(nodes: Column) -> Column:
    """Each node of a run with its siblings."""
    beside = lambda n: F.struct(
        _all(F.slice(nodes, 1, n["at"])).alias("left"), _all(F.slice(nodes, n["at"] + 2, F.lit(RUN))).alias("right")
    )
    return F.transform(nodes, lambda n: F.struct(beside(n).alias("step"), n.alias("node")))


def _open(blocks: DataFrame, above: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Each node of the blocks: grp, rank, h, payload, path, top.

    ``above`` has the path of each block's node, (grp, block, path, top). The path of a node
    is its siblings level by level up to the root.
    """
    opened = (
        blocks.select("grp", "block", "levels", "kids")
        .unionByName(above.select("grp", "block", "path", "top"), allowMissingColumns=True)
        .groupBy("grp", "block")
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", "top")])
    )
    # One digit at a time. Only a node's own children go on, and the steps above them: a row
    # never carries its whole block.
    keep = [F.col(c) for c in ("grp", "block", "levels", "path", "top")]
    place, steps = F.lit(0), F.expr(f"CAST(array() AS array<{_STEP}>)")
    kids = F.col("kids")
    for k in reversed(range(DIGITS)):
        here = opened.select(*keep, place.alias("place"), steps.alias("steps"), F.explode(_paired(kids)).alias("one"))
        place = F.shiftleft("place", DIGIT) + F.col("one.node.at")
        steps = F.concat(F.array("one.step"), "steps")
        opened, kids = here, F.col("one.node.kids") if k else None
    rank = F.shiftleft("block", DIGIT * DIGITS) + place
    return opened.select(
        "grp",
        rank.cast("bigint").alias("rank"),
        *[F.col("one.node")[c].alias(c) for c in ("h", *payload)],
        F.concat(F.slice(steps, 1, F.col("levels")), "path").alias("path"),
        "top",
    )


def _paths(tiers: Sequence[DataFrame], above: DataFrame, payload: Sequence[str]) -> DataFrame:
    """From the top tier down to its leaves. ``above``: grp, path, top of each group's last node."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(tiers[1:]):
        above = _open(blocks, above, ()).withColumnRenamed("rank", "block")
    return _open(tiers[0], above, payload)


def proofs(docs: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """doc_id, leaf, changed, subroot, root and path of each row.

    ``docs`` has ``LEAF_COLUMNS`` and, where rows have been altered since, ``changed``: the
    leaf as it is now, else null. Rows ascend by doc_id within their source (nulls first, ties
    by leaf); rows without a source are a source of their own, the first. Repeated rows are
    leaves of their own. ``path`` is an array of (left, right), what stands beside the node in
    its run, level by level from the leaf up to the root. An empty table gives none.
    """
    ranked = number_within(
        docs.select(F.col("source").alias("grp"), "doc_id", F.col("leaf").alias("h"), "changed"),
        ["grp"],
        [F.asc_nulls_first("doc_id"), F.asc("h")],
        "rank",
    ).withColumn("rank", F.col("rank") - 1)
    payload = ("doc_id", "changed")
    tiers = _tiers(ranked, payload)
    subroots = tiers[-1].select(F.col("grp").alias("source"), "h")
    over = number_within(subroots, [], [F.asc_nulls_first("source")], "rank", stored=True)
    over = over.select(F.lit(0).alias("grp"), (F.col("rank") - 1).alias("rank"), "h", "source")
    sources = _tiers(over, ("source",))
    none = F.expr(f"CAST(array() AS array<{_STEP}>)")
    root = sources[-1].select("grp", none.alias("path"), F.struct(F.col("h").alias("root"), F.lit(None).cast("string").alias("subroot")).alias("top"))
    above = _paths(sources, root, ("source",)).select(
        F.col("source").alias("grp"), "path", F.struct("top.root", F.col("h").alias("subroot")).alias("top")
    )
    out = _paths(tiers, write_scratch(above), payload)
    return out.select("doc_id", F.col("grp").alias("source"), F.col("h").alias("leaf"), "changed", "top.subroot", "top.root", "path")


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its siblings make."""
    return F.aggregate(path, node, lambda acc, step: _sha(step["left"], acc, step["right"]))


def manifest(docs: DataFrame, altered: Column, text_now: Column) -> DataFrame:
    """Leaf, subroots, root and proof of each document, and whether its present text proves it.

    Rows where ``altered`` holds now have the text ``text_now`` instead of what the tree was
    built of. Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Other columns of ``docs`` are not read; see ``proofs`` for nulls, ties and repeated rows.
    """
    values = [F.col(c) for c in LEAF_COLUMNS]
    leaves = docs.select(
        "doc_id",
        "source",
        leaf(values).alias("leaf"),
        F.when(altered, leaf([*values[:-1], text_now])).alias("changed"),
    )
    proven = proofs(leaves).withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: texts whose decimal doc_id has a checksum divisible by 5 turn to lower case."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    altered = F.coalesce(crc % 5 == 0, F.lit(False)) & F.col("text").isNotNull()
    return manifest(docs, altered, F.translate("text", UPPER, LOWER))
