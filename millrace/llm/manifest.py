"""Merkle manifest of a table of documents, with slot pivots.

A row's leaf is the SHA-256 of its fields, each behind its length. The leaves of a
source stand in the order of doc_id; every ``FANOUT`` of them become a parent, up to
one subroot a source, and the subroots by source become the root in the same way.

A level is one aggregation: a conditional aggregate for each slot spreads the children
of a parent into as many columns. All columns side by side hash to the parent; without
the column of a child's own slot they are its siblings, in the parts on its left and on
its right. Going down from the root, a parent hands its children the siblings on their
way up, so a document meets the whole way in a single join.

Places come from a sort by ranges, so a source with very many rows has no task to
itself: tasks count their rows of each source, and the counts before are added. Only
ids and digests are shuffled, never texts.

A null field is ``-``. A null source is a source of its own, before all others; null
ids come before others. Rows that repeat an id stand in the order of their leaves;
equal rows have equal leaves and each gives a row. An empty table has no root and
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SLOTS = [f"slot_{k}" for k in range(FANOUT)]
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_of(**instead: Column) -> Column:
    """The digest of a row, with other values in the named fields."""
    parts = []
    for name in FIELDS:
        value = instead.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def verified_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Every document's digests and proof, and whether it still leads to the root.

    Gives ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. Rows
    where ``tampered`` holds are read again with their text in lower case.
    """
    changed = F.when(tampered & F.col("text").isNotNull(), leaf_of(text=F.translate("text", *_LOWER)))
    # A null source is the empty key, and others sort behind it by their bytes.
    tree = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    leaves = written(docs.select(tree.alias("tree"), "doc_id", leaf_of().alias("digest"), changed.alias("changed")))
    placed = _placed(leaves, ["doc_id", "digest"])
    levels, subroots = _levels(placed)
    over = _placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), ["source"])
    top_levels, roots = _levels(over)
    # The root is a single value.
    root = next((row.digest for row in roots.take(1)), None)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    ways = _ways(top_levels, roots.select("tree", nothing.alias("way"), F.lit("").alias("subroot")))
    above = _with_ways(over, ways).select(F.col("source").alias("tree"), "way", F.col("digest").alias("subroot"))
    rows = _with_ways(placed, _ways(levels, written(above)))
    proof = F.array_join(F.transform("way", lambda s: F.concat(s["left"], s["right"])), "")
    start = F.coalesce("changed", "digest")
    folded = F.aggregate("way", start, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _placed(nodes: DataFrame, order_by: list[str]) -> DataFrame:
    """``nodes`` with their place in their tree, ``pos``, and the number of nodes there, ``n``.

    The rows sorted by ranges are written before their places are read, as a second
    sort may draw other ranges.
    """
    keys = ["tree", *order_by]
    ordered = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = written(ordered.withColumn("id", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("id", 33))
    runs = ordered.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("id").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = ordered.join(runs, ["tree", "part"])
    return placed.withColumn("pos", F.col("id") + F.col("shift")).drop("id", "part", "shift")


def _levels(placed: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Parents by level, ``tree, n, parent`` and a column for every slot; and the top digest of each tree.

    The first level has the trees with a single node, too, which need no parent.
    """
    nodes = placed.select("tree", "n", "pos", "digest")
    levels, tops, width = [], [], 1
    while True:
        slot = F.col("pos") % FANOUT
        pivot = [F.max(F.when(slot == k, F.col("digest"))).alias(name) for k, name in enumerate(_SLOTS)]
        level = written(nodes.groupBy("tree", "n", F.expr(f"pos div {FANOUT}").alias("parent")).agg(*pivot))
        if not levels:
            tops.append(level.filter("n = 1").select("tree", F.col(_SLOTS[0]).alias("digest")))
        elif level.isEmpty():
            break
        levels.append(level)
        width *= FANOUT
        parents = level.filter("n > 1").select("tree", "n", F.col("parent").alias("pos"), F.sha2(F.concat_ws("", *_SLOTS), 256).alias("digest"))
        tops.append(parents.filter(F.col("n") <= width).select("tree", "digest"))
        nodes = parents.filter(F.col("n") > width)
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return levels, top


def _step(slot: Column, prefix: str = "") -> Column:
    """What stands on the left and on the right of a slot."""
    left = F.concat_ws("", *[F.when(slot > k, F.col(prefix + name)) for k, name in enumerate(_SLOTS)])
    right = F.concat_ws("", *[F.when(slot < k, F.col(prefix + name)) for k, name in enumerate(_SLOTS)])
    return F.struct(left.alias("left"), right.alias("right"))


def _ways(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Parents of the first level with the steps from there to the root, ``way``.

    ``tops`` has the way of each tree's top, and further columns that all of it keeps.
    """
    lower, width = None, FANOUT ** len(levels)
    for level in reversed(levels):
        ways = level.filter(F.col("n") <= width).join(tops, "tree")
        if lower is not None:
            children = level.filter(F.col("n") > width).withColumn("of", F.expr(f"parent div {FANOUT}"))
            parents = lower.select("tree", F.col("parent").alias("of"), *[F.col(s).alias(f"of_{s}") for s in _SLOTS], "way", "subroot")
            step = _step(F.col("parent") % FANOUT, "of_")
            handed = children.join(parents, ["tree", "of"]).withColumn("way", F.concat(F.array(step), "way"))
            ways = ways.unionByName(handed.select(*ways.columns))
        lower = written(ways)
        width //= FANOUT
    return lower


def _with_ways(placed: DataFrame, ways: DataFrame) -> DataFrame:
    """Nodes with their own steps in front of those of their parents."""
    parent = F.expr(f"pos div {FANOUT}")
    rows = placed.withColumn("parent", parent).join(ways.drop("n"), ["tree", "parent"])
    own = _step(F.col("pos") % FANOUT)
    return rows.withColumn("way", F.when(F.col("n") == 1, F.col("way")).otherwise(F.concat(F.array(own), "way"))).drop(*_SLOTS)
