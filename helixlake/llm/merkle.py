"""Merkle dataset manifest: a hash tree over the rows of each group, one over the groups, and a proof for every row.

A leaf is the hash of a row's fields, each by its length and value. Leaves of a group stand in order; every two
consecutive nodes, or one that is left alone, become the hash of their digests, until one remains, the group's
root. The roots of the groups, in order, make the tree's root in the same way.

Method: fixed-offset windows. In a block of 2^LEVELS consecutive rows the first row of every node carries its
digest. On level j a node's sibling begins 2^j rows further on or back, so lag and lead by that offset, masked by
the node's slot and by the length of the run, supply it, and the first child's row hashes the parent. All levels of
a block share one sort. At the end every row takes the siblings of the nodes above it from the rows where they
begin. The blocks of a group are the nodes of the next round, so a round takes away LEVELS levels, and no task holds
more than a block, whatever share of the rows a group has. Places in a group come from a range partition and the
counts of its parts.

Null fields are told from empty ones. Groups may be null, which come first. Rows with a null key come first in their
group; rows that share a key go by their leaves, and equal rows are leaves of their own. Texts may be of any length.
An empty table gives an empty result; columns beyond the named ones are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

LEVELS = 10  # levels of a block


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal sha256 of the parts on end."""
    return F.sha2(F.concat(*parts), 256)


def field(c: str | Column) -> Column:
    """'-' for null, else the bytes of the value as text, ':' and the value."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[str | Column]) -> Column:
    return digest(*[field(c) for c in fields])


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with pos, their place from 0 on in their group, and n, the rows of the group.

    Rows are dealt by ranges of (group, order); a part of a group counts for itself, and the parts before it add up.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(rows.repartitionByRange(n, group, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(group).orderBy("__part")
    before = F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), before.alias("__before"), F.sum("__c").over(Window.partitionBy(group)).alias("n"))
    nth = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)) - 1
    found = ranged.withColumn("__nth", nth.cast("long")).join(counts, (F.col(group).eqNullSafe(F.col("__g"))) & (F.col("__part") == F.col("__p")))
    return found.select(*rows.columns, (F.col("__before") + F.col("__nth")).alias("pos"), "n")


def climbed(nodes: DataFrame, group: str, levels: int = LEVELS) -> DataFrame:
    """nodes (group, pos, n, digest, ...) with block, top, the digest above a node after ``levels`` levels or at the root of
    its group if that comes first, and path, what is hashed on the way there.

    A step of the path is the sibling's digest behind 'l' or 'r', the side it stands on; 'r' alone where there is none.
    """
    n, pos = F.col("n"), F.col("pos")
    w = Window.partitionBy(group, "block").orderBy("pos")
    rows = nodes.withColumn("block", F.shiftrightunsigned("pos", levels)).withColumn("__d", F.col("digest"))
    for j in range(levels):
        step = 1 << j
        own = pos.bitwiseAND(F.lit(step - 1)) == 0  # the first row of a node
        right = pos.bitwiseAND(F.lit(step)) != 0
        rows = rows.withColumns({"__after": F.lead("__d", step).over(w), "__before": F.lag("__d", step).over(w)})
        beside = F.when(right, F.col("__before")).otherwise(F.when(pos + step < n, F.col("__after")))
        rows = rows.withColumn(f"__s{j}", F.when(own, F.coalesce(beside, F.lit(""))))
        parent = F.when(n > step, digest(F.col("__d"), F.col(f"__s{j}"))).otherwise(F.col("__d"))
        rows = rows.withColumn("__d", F.when(own & ~right, parent)).drop("__after", "__before")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"__s{j}": F.last(f"__s{j}", True).over(so_far) for j in range(levels)} | {"top": F.last("__d", True).over(so_far)})
    side = lambda j: F.when(pos.bitwiseAND(F.lit(1 << j)) != 0, "l").otherwise("r")
    steps = F.array(*[F.when(n > (1 << j), F.concat(side(j), F.col(f"__s{j}"))) for j in range(levels)])
    return rows.select(*nodes.columns, "block", "top", F.array_compact(steps).alias("path"))


def climb(nodes: DataFrame, group: str, levels: int = LEVELS) -> list[DataFrame]:
    """Tables of :func:`climbed`: of the nodes, of their blocks, of the blocks of those, until each group is one block."""
    made = []
    while True:
        made.append(materialise(climbed(nodes, group, levels), "climbed"))
        if made[-1].where(F.col("n") > (1 << levels)).isEmpty():
            return made
        first = made[-1].where(F.col("pos").bitwiseAND(F.lit((1 << levels) - 1)) == 0)
        nodes = first.select(group, F.col("block").alias("pos"), F.shiftrightunsigned(F.col("n") + ((1 << levels) - 1), levels).alias("n"), F.col("top").alias("digest"))


def descended(made: list[DataFrame], group: str, above: DataFrame | None = None) -> DataFrame:
    """The nodes of :func:`climb` with their whole path, and the root of their group as top.

    above: (group, path, ...) from each group's root on. It joins the last table, in which a group has one block of
    rows, so no group's rows ever meet there.
    """
    same = lambda a, b: a[group].eqNullSafe(b[group])
    found, more = made[-1], []
    if above is not None:
        more = [c for c in above.columns if c not in (group, "path")]
        found = found.join(above, same(found, above), "left").select(*[found[c] for c in found.columns if c != "path"], F.concat(found["path"], above["path"]).alias("path"), *[above[c] for c in more])
    for lower in reversed(made[:-1]):
        upper = found.select(F.col(group).alias("__g"), F.col("pos").alias("__pos"), F.col("path").alias("__path"), F.col("top").alias("__top"), *more)
        joined = lower.join(upper, lower[group].eqNullSafe(upper["__g"]) & (lower["block"] == upper["__pos"]))
        found = joined.select(*[lower[c] for c in lower.columns if c not in ("path", "top")], F.col("__top").alias("top"), F.concat(lower["path"], F.col("__path")).alias("path"), *more)
    return found


def folded(start: str | Column, path: str | Column) -> Column:
    """The root that a path makes of a leaf's digest."""
    beside = lambda s: F.substring(s, 2, 64)
    return F.aggregate(path, F.col(start) if isinstance(start, str) else start, lambda d, s: F.sha2(F.when(s.startswith("l"), F.concat(beside(s), d)).otherwise(F.concat(d, beside(s))), 256))


def proof(path: str | Column) -> Column:
    """The siblings of a path on end."""
    return F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "")


def manifest(rows: DataFrame, group: str, key: str, fields: list[str], more: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """key, leaf, subroot, root and path of every row of ``rows``; more: further columns worked out of the row, each under its name."""
    more = more or {}
    own = [F.col(key).alias("key"), F.col(group).alias("part"), leaf(fields).alias("digest"), *[c.alias(name) for name, c in more.items()]]
    leaves = materialise(rows.select(*own).withColumn("__row", F.monotonically_increasing_id()), "leaves")
    made = climb(placed(leaves, "part", ["key", "digest", "__row"]).drop("__row"), "part", levels)
    roots = made[-1].where("pos = 0").select(F.col("part").alias("name"), F.col("top").alias("digest"), F.lit("").alias("all"))
    over = descended(climb(placed(roots, "all", ["name"]), "all", levels), "all")
    above = materialise(over.select(F.col("name").alias("part"), F.col("digest").alias("subroot"), F.col("top").alias("root"), "path"), "subroots")
    found = descended(made, "part", above)
    return found.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path", *more)
