"""Merkle manifest of a dataset: one tree per source, one over the sources, a proof for every row.

Leaves are numbered within their tree by ranges, and every FANOUT**HEIGHT neighbours form a superblock.  Going up,
each superblock becomes one node; the nodes form superblocks again, until each tree is one.  Going down, the nodes of
a superblock are cogrouped with its outer nodes, the siblings on its way to the root: one function reduces
the nodes again, joins their inner and outer siblings to whole proofs, and folds the leaves.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import materialised

FANOUT = 3
HEIGHT = 7  # levels of a superblock: at most 3 ** 7 = 2187 nodes meet in one group
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SIDES = "left array<string>, right array<string>, subroot string, root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """Hash of a row's values: each "-" if null, else its UTF-8 length, a colon and its text."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def grown(nodes: list[str], height: int | None, fanout: int = FANOUT) -> list[list[str]]:
    """The levels above neighbouring nodes: ``height`` of them, or up to a single node if None."""
    out = [nodes]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[k : k + fanout])) for k in range(0, len(last), fanout)])
    return out


def siblings(level: list[str], k: int, fanout: int = FANOUT) -> tuple[str, str]:
    """The nodes of k's run before and after it, joined."""
    lo = k - k % fanout
    return "".join(level[lo:k]), "".join(level[k + 1 : lo + fanout])


def fold(node: str, left: list[str], right: list[str]) -> str:
    """The root that a node and the siblings on its way there give."""
    for before, after in zip(left, right):
        node = digest(before + node + after)
    return node


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Rows with ``pos``, their place in their ``tree`` in the given order, and ``size``, the rows of the tree.

    Ranges of (tree, order) are numbered in their tasks; a tree's tasks get offsets from one row per tree and task.
    Nulls come first.  A number for each row is the last key, so that equal rows do not meet in one task.
    """
    rows = materialised(rows.withColumn("twin", F.monotonically_increasing_id()), label)
    keys = ["tree", *order, "twin"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("twin")
    dealt = dealt.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = materialised(dealt, label)
    held = dealt.groupBy("task", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("task")) - F.col("n")
    held = held.select("task", "tree", (before - F.col("first")).alias("offset"), F.sum("n").over(tree).alias("size"))
    out = dealt.join(held, ["task", "tree"]).withColumn("pos", F.col("at") + F.col("offset"))
    return out.drop("task", "at", "offset")


def blocks(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(fanout**height)).cast("long"))


def climb(nodes: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """The nodes of every superblock level, (tree, pos, size, hash), up to one node per tree."""
    span = fanout**height

    def reduced(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        size = int(group["size"].iloc[0])
        top = grown(group["hash"].tolist(), None if size <= span else height, fanout)[-1][0]
        return pd.DataFrame({
            "tree": [group["tree"].iloc[0]], "pos": [group["block"].iloc[0]], "size": [-(-size // span)], "hash": [top],
        })

    out = [nodes.select("tree", "pos", "size", "hash")]
    while True:
        up = blocks(out[-1], fanout, height).groupBy("tree", "block").applyInPandas(
            reduced, "tree string, pos long, size long, hash string"
        )
        out.append(materialised(up, "merkle-nodes"))
        if (out[-1].agg(F.max("size")).first()[0] or 0) <= 1:
            return out


def descend(nodes: DataFrame, outer: DataFrame, finish, schema: str, fanout: int, height: int) -> DataFrame:
    """Cogroup the nodes of every superblock with its outer siblings.

    ``finish(row, left, right, outer)`` makes a result row of each node from the siblings on its whole way.
    """
    span = fanout**height
    names = [c.split()[0] for c in schema.split(", ")]

    def work(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, above = inner.sort_values("pos"), above.iloc[0]
        whole = int(inner["size"].iloc[0]) <= span
        levels = grown(inner["hash"].tolist(), None if whole else height, fanout)[:-1]
        # siblings of the upper levels are shared by all nodes below, so they are joined from the top
        paths = [(list(above["left"]), list(above["right"]))]
        for level in reversed(levels):
            step = []
            for k in range(len(level)):
                before, after = siblings(level, k, fanout)
                left, right = paths[k // fanout]
                step.append(([before, *left], [after, *right]))
            paths = step
        out = [finish(row, *path, above) for row, path in zip(inner.itertuples(index=False), paths)]
        return pd.DataFrame(out, columns=names)

    held = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return blocks(nodes, fanout, height).groupBy("tree", "block").cogroup(held).applyInPandas(work, schema)


def manifest(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT, proofs: bool = True) -> DataFrame:
    """doc_id, leaf, subroot, root, left, right, proof_sha256, folded_root and verified of every leaf.

    ``left`` and ``right`` are the proof: the siblings on both sides from the leaf up, left out without ``proofs``.
    ``leaves`` has doc_id, source, leaf and candidate, the hash that is folded with the proof and must give the root.
    Within a source leaves ascend by doc_id, null first, then by leaf and candidate; rows may repeat and are leaves
    each.  Sources ascend bytewise, null first and apart from an empty one.  No leaves give no rows.  Groups have at
    most ``fanout ** height`` nodes however many rows a source holds; the driver sees one number per superblock level.
    """
    # an equals sign keeps an empty source apart from a null one and changes no order
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = leaves.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), F.col("leaf").alias("hash"), "candidate")
    rows = placed(rows, ["doc_id", "hash", "candidate"], "merkle-leaves")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))  # ids stay exact beside nulls
    levels = climb(rows, fanout, height)
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    tops = placed(tops, ["name"], "merkle-sources")
    above = climb(tops, fanout, height)

    def node(row, left, right, up):
        return row.tree, row.pos, left, right, up["subroot"], up["root"]

    def source(row, left, right, up):
        return row.name, 0, left, right, row.hash, up["root"]

    def proven(row, left, right, up):
        root = fold(row.candidate, left, right)
        proof = digest("".join(before + after for before, after in zip(left, right)))
        shown = (left, right) if proofs else ()
        return row.doc_id, row.hash, up["subroot"], up["root"], *shown, proof, root, root == up["root"]

    none = F.array().cast("array<string>")
    outer = above[-1].select(
        "tree", "pos", none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root")
    )
    placing = f"tree string, pos long, {_SIDES}"
    for nodes in reversed(above[1:-1]):
        outer = descend(nodes, outer, node, placing, fanout, height)
    outer = descend(tops, outer, source, placing, fanout, height)
    for nodes in reversed(levels[1:-1]):
        outer = descend(nodes, outer, node, placing, fanout, height)
    shown = "left array<string>, right array<string>, " if proofs else ""
    result = (
        f"doc_id string, leaf string, subroot string, root string, {shown}"
        "proof_sha256 string, folded_root string, verified boolean"
    )
    return descend(rows, outer, proven, result, fanout, height).withColumn("doc_id", F.col("doc_id").cast("long"))


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source, leaf and candidate of documents; the candidate lacks the text's line feeds where ``tampered``.

    Absent columns count as null, a null condition as false; other columns play no part.
    """
    values = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in FIELDS}
    changed = {**values, "text": F.replace(values["text"], F.lit("\n"), F.lit(""))}
    whole = leaf(list(values.values()))
    return docs.select(
        values["doc_id"].cast("long").alias("doc_id"), values["source"].alias("source"), whole.alias("leaf"),
        F.when(tampered, leaf(list(changed.values()))).otherwise(whole).alias("candidate"),
    )
