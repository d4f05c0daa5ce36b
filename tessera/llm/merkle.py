"""Merkle dataset manifest with nested-interval labels.

Every node of a tree is labelled with the interval of leaf ranks it covers. A
node is an ancestor of a leaf if its interval contains the leaf's rank, and the
sibling on the way up is what is left of the parent's interval without the
child's own. No pointers are stored and no path is walked.

Levels come in buckets of ``HEIGHT``. The members of a bucket (the leaves in the
first one) are cut into blocks of ``2**HEIGHT`` consecutive ones; a block's inner
nodes cover nothing outside it, so the containment join that attaches ancestors
runs on the block, and each member meets the at most ``2**HEIGHT - 1`` nodes of
its own block only. The block's top is a member of the next bucket, where there
are fewer by the factor ``2**HEIGHT``; its proof is worked out once and handed
down to all members of the block. So the work grows with the number of leaves,
the number of jobs with its logarithm to the base ``2**HEIGHT``, and no tree,
however large, is gathered anywhere.

Trees are per value of a column; their tops, ordered by that value (null first),
are the leaves of one more tree, whose top is the root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranking import group_positions, sequential_ids
from ..operators.staging import stage_table

#: Levels of a bucket: blocks of 256 members.
HEIGHT = 8


def digest(*columns: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the concatenated texts (none may be null)."""
    return F.sha2(F.concat(*columns), 256)


def leaf_digest(*columns: Column) -> Column:
    """The digest of a row: each column as ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""
    texts = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def siblings(proof: Column) -> Column:
    """The digests of a proof one after another, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _blocks(members: DataFrame, bucket: int) -> DataFrame:
    """(tree, block, size, row0 .. row<HEIGHT>): the digests of each block, level by
    level. A tree that fits into one block ends at its top, all blocks of a larger
    tree have all ``HEIGHT`` levels."""
    blocks = members.groupBy("tree", F.shiftright("rank", HEIGHT).alias("block")).agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("row0"))
    blocks = blocks.withColumn("row0", F.col("row0.digest"))
    for level in range(1, HEIGHT + 1):
        below = f"row{level - 1}"
        above = (f"transform(sequence(0, int(ceil(size({below}) / 2)) - 1), "
                 f"i -> sha2(concat(get({below}, 2 * i), coalesce(get({below}, 2 * i + 1), '')), 256))")
        # There is a level above as long as the level below has several nodes in the whole tree.
        several = f"size > {1 << bucket * HEIGHT + level - 1}L"
        blocks = blocks.withColumn(f"row{level}", F.expr(f"if({several}, {above}, null)"))
    return blocks


def _tops(blocks: DataFrame) -> DataFrame:
    """(tree, rank, size, digest): the top of every block, as members of the next bucket."""
    top = F.coalesce(*[F.get(f"row{level}", F.lit(0)) for level in range(HEIGHT, -1, -1)])
    return blocks.select("tree", F.col("block").alias("rank"), "size", top.alias("digest"))


def _nodes(blocks: DataFrame, bucket: int) -> DataFrame:
    """(tree, block, level, low, middle, high, left, right): the inner nodes of the
    bucket. A node covers the leaf ranks low to high, its second child those from
    middle on (none, if middle is beyond high)."""
    rows = []
    for level in range(1, HEIGHT + 1):
        below, width = f"row{level - 1}", 1 << bucket * HEIGHT + level
        low = f"shiftleft(block, {(bucket + 1) * HEIGHT}) + bigint(i) * {width}L"
        rows.append(f"""coalesce(transform(row{level}, (x, i) -> struct(
            {bucket * HEIGHT + level} AS level, {low} AS low, {low} + {width // 2}L AS middle, least({low} + {width}L, size) - 1 AS high,
            get({below}, 2 * i) AS left, coalesce(get({below}, 2 * i + 1), '') AS right)), array())""")
    return blocks.select("tree", "block", F.expr(f"inline(concat({', '.join(rows)}))"))


def _climb(members: DataFrame, most: int) -> list[tuple[DataFrame, DataFrame]]:
    """(members, blocks) of every bucket, from the leaves up to the one in which
    every tree is a single block; ``most`` is the greatest number of leaves."""
    buckets = []
    while True:
        blocks = stage_table(_blocks(members, len(buckets)), "merkle-blocks")
        buckets.append((members, blocks))
        if most <= 1 << HEIGHT:
            return buckets
        most = -(-most >> HEIGHT)
        members = stage_table(_tops(blocks), "merkle-members")


def _descend(buckets: list[tuple[DataFrame, DataFrame]], above: DataFrame, about: list[str], keep: list[str]) -> DataFrame:
    """(tree, rank, digest, ``keep``, ``about``, proof) of all leaves. ``above`` has
    (tree, rank, ``about``, proof) for the top of each tree, which is handed down."""
    for bucket in range(len(buckets) - 1, -1, -1):
        members, blocks = buckets[bucket]
        own = ["digest", *(keep if bucket == 0 else [])]
        at = F.shiftleft("m.rank", bucket * HEIGHT)
        inside = (F.col("m.tree") == F.col("n.tree")) & (F.col("m.block") == F.col("n.block")) & (F.col("n.low") <= at) & (at <= F.col("n.high"))
        # The sibling is the rest of the node's interval without the child's: the
        # first child's if the leaf lies from middle on, else the second's, if any.
        second = at >= F.col("n.middle")
        step = F.when(F.col("n.level").isNotNull(), F.struct(
            F.col("n.level").alias("level"), F.when(second, F.col("n.left")).otherwise("").alias("left"),
            F.when(second, "").otherwise(F.col("n.right")).alias("right")))
        met = (members.withColumn("block", F.shiftright("rank", HEIGHT)).alias("m").join(_nodes(blocks, bucket).alias("n"), inside, "left")
               .groupBy("m.tree", "m.block", "m.rank")
               .agg(*[F.first(F.col(f"m.{c}")).alias(c) for c in own], F.sort_array(F.collect_list(step)).alias("steps")))
        steps = F.transform("steps", lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right")))
        met = met.join(above.drop("digest").withColumnRenamed("rank", "block"), ["tree", "block"])
        above = met.select("tree", "rank", *own, *about, F.concat(steps, "proof").alias("proof"))
    return above


def merkle_manifest(leaves: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", leaf_col: str = "leaf",
                    carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, leaf, ``carry`` columns, subroot, root, proof), one row for each row of ``leaves``.

    Leaves ascend by id in the tree of their ``tree_col`` value (rows without an id
    first, repeated ids by leaf; equal leaves of one id may change places, which
    changes no digest). Every two consecutive nodes become their digest, a last
    lone one the digest of itself, until one is left, the subroot; a lone leaf is
    the subroot itself. Subroots, ordered by tree value (null first, then by
    UTF-8 bytes), give the root in the same way. ``proof`` leads from the leaf to
    the root (see ``fold``): for every level the sibling's digest on its side and
    an empty text on the other, both empty for a node without a sibling.

    A null leaf fails the job. Columns other than the named ones are ignored,
    whatever their names. An empty table gives no rows.
    """
    named = {f"c{i}": c for i, c in enumerate(carry)}
    known = F.coalesce(F.col(leaf_col), F.raise_error(F.lit("a leaf is null")))
    value = F.struct(F.col(id_col).alias("id"), known.alias("digest"), *[F.col(c).alias(a) for a, c in named.items()])
    rows = leaves.select(F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("-")).alias("tree"), value.alias("value"))
    placed, parts = group_positions(rows, ["tree"], "value")
    parts = parts.join(parts.groupBy("tree").agg(F.sum("_cnt").alias("size")), "tree").select("tree", "_pid", "_first", "_before", "size")
    rank = F.col("_before") + F.col("_pos") - F.col("_first")
    placed = stage_table(placed.join(parts, ["tree", "_pid"]).select("tree", rank.alias("rank"), "size", "value.*"), "merkle-leaves")
    inner = _climb(placed, placed.agg(F.max("size")).first()[0] or 0)
    tops = sequential_ids(_tops(inner[-1][1]).select("tree", "digest"), ["tree"], "rank", start=0)
    n_trees = tops.count()
    tops = stage_table(tops.select(F.lit("").alias("tree"), "rank", F.lit(n_trees).cast("long").alias("size"), "digest",
                                   F.col("tree").alias("name")), "merkle-trees")
    outer = _climb(tops, n_trees)
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = _tops(outer[-1][1]).select("tree", "rank", F.col("digest").alias("root"), none.alias("proof"))
    subroots = _descend(outer, root, ["root"], ["name"]).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("rank"), F.col("digest").alias("subroot"), "root", "proof")
    return _descend(inner, stage_table(subroots, "merkle-subroots"), ["subroot", "root"], ["id", *named]).select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), *[F.col(a).alias(c) for a, c in named.items()], "subroot", "root", "proof")
