"""Merkle manifest of a dataset: a tree of digests per group, a tree over the groups, and a proof for every row.

Only digests are shuffled, never texts. A parallel sort gives each leaf its rank within its group; the rank's digits to
the base of the fan-out are columns. Leaves are brought together in blocks of a bounded number of ranks, and there one
digit column after the other is grouped away: the nodes that differ in this digit alone become the child structs of
one node. A block's digest is a leaf of the tier above, until one node is left in each group; the groups' last nodes
are the leaves of a tree over all groups. Downwards, each level of nested structs is transformed into children with
their left and right siblings and exploded, so that the proofs come out of the structs without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import fold_of, stored

FAN_OUT = 3
#: Rank digits that are grouped away within a block: a block holds at most FAN_OUT ** DIGITS leaves.
DIGITS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = "array<struct<left string, right string>>"
# ``monotonically_increasing_id`` holds the task in the bits above these and the row below.
ROW_BITS = 33


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def group_key(name: str) -> Column:
    """The group as text that sorts by its bytes after the null group, which is empty."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Leaves with their ``rank`` (from 0) in the ``group`` and the group's ``total``.

    Ranges of (group, order) are sorted in tasks of their own, so a group of any size is spread over many; each task
    then counts its rows per group, and the counts of the tasks before it shift its ranks.
    """
    keys = ["group", *order]
    at = F.monotonically_increasing_id()
    placed = stored(leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", at), "leaves")
    placed = placed.select(*leaves.columns, F.shiftright("_at", ROW_BITS).alias("_part"), F.col("_at").alias("_at"))
    here = placed.groupBy("_part", "group").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    line = Window.partitionBy("group").orderBy("_part")
    before = F.coalesce(F.sum("_rows").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_rows").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    shifts = here.select("_part", "group", (before - F.col("_first")).alias("_shift"), total.alias("total"))
    return placed.join(shifts, ["_part", "group"]).select(
        *leaves.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "total"
    )


def roll_up(nodes: DataFrame, fan_out: int = FAN_OUT, digits: int = DIGITS) -> DataFrame:
    """(group, total, block, node): the nodes of each block as one nested struct of ``digest`` and ``kids``.

    ``nodes`` has group, rank, total and a struct ``node`` with a ``digest``. Where a level of a group has one node
    only, the tree has ended: that node goes up unchanged. All groupings take place where ``repartition`` has put the
    blocks.
    """
    rank = F.col("rank")
    names = [f"_d{j}" for j in range(digits)]
    rest = [F.floor(rank / F.lit(fan_out**j)).cast("long") for j in range(digits + 1)]
    columns = [(rest[j] % fan_out).cast("int").alias(names[j]) for j in range(digits)]
    rows = nodes.select("group", "total", rest[digits].alias("block"), *columns, "node").repartition("group", "block")
    for j in range(digits):
        keys = ["group", "block", "total", *names[j + 1 :]]
        kids = F.transform(F.array_sort(F.collect_list(F.struct(names[j], "node"))), lambda k: k["node"])
        whole = digest(F.array_join(F.transform("kids", lambda k: k["digest"]), ""))
        own = F.when(F.col("total") > fan_out**j, whole).otherwise(F.col("kids")[0]["digest"])
        rows = rows.groupBy(*keys).agg(kids.alias("kids")).select(*keys, F.struct(own.alias("digest"), "kids").alias("node"))
    return rows


def lay_open(trees: DataFrame, kept: Sequence[str], fan_out: int = FAN_OUT, digits: int = DIGITS) -> DataFrame:
    """The leaf nodes of the trees with ``levels``: the siblings left and right of the path, from the leaf upwards.

    ``trees`` has total, block, node, levels (the siblings above the block) and the columns ``kept``.
    """
    rows = trees.select(*kept, "total", "levels", F.col("block").alias("rank"), "node")
    for j in reversed(range(digits)):
        digests = F.transform("node.kids", lambda k: k["digest"])
        sides = F.transform(
            "node.kids",
            lambda k, i: F.struct(
                k.alias("node"),
                i.alias("digit"),
                F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
                F.array_join(F.slice(digests, i + 2, F.lit(fan_out)), "").alias("right"),
            ),
        )
        exploded = rows.select(*kept, "total", "levels", "rank", F.explode(sides).alias("at"))
        step = F.when(F.col("total") > fan_out**j, F.array(F.struct("at.left", "at.right"))).otherwise(
            F.array().cast(LEVELS)
        )
        rows = exploded.select(
            *kept,
            "total",
            F.concat(step, "levels").alias("levels"),
            (F.col("rank") * fan_out + F.col("at.digit")).alias("rank"),
            F.col("at.node").alias("node"),
        )
    return rows


def forest(nodes: DataFrame, fan_out: int = FAN_OUT, digits: int = DIGITS) -> list[DataFrame]:
    """Tiers of nested trees, the leaves' first; the last tier has one tree a group, whose digest is the group's root."""
    tiers, most = [], nodes.agg(F.max("total")).first()[0] or 0
    while True:
        tiers.append(stored(roll_up(nodes, fan_out, digits), "trees"))
        size = fan_out**digits
        if most <= size:
            return tiers
        most = -(-most // size)
        up = F.ceil(F.col("total") / F.lit(size)).cast("long").alias("total")
        nodes = tiers[-1].select("group", F.col("block").alias("rank"), up, F.struct("node.digest").alias("node"))


def descend(tiers: list[DataFrame], tops: DataFrame, kept: Sequence[str], fan_out: int = FAN_OUT, digits: int = DIGITS) -> DataFrame:
    """Leaf nodes of all tiers' trees with their ``levels``, under ``tops``: (group, levels, kept columns) a group.

    A path from above and the tree that continues it share a group and a block. Both are one row, and grouping by
    these two columns puts them together.
    """
    paths = tops.select("group", F.lit(0).cast("long").alias("block"), "levels", *kept)
    for trees in reversed(tiers):
        both = trees.unionByName(paths, allowMissingColumns=True).groupBy("group", "block")
        names = ["total", "node", "levels", *kept]
        whole = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
        rows = lay_open(whole, ["group", *kept], fan_out, digits)
        paths = rows.select("group", F.col("rank").alias("block"), "levels", *kept)
    return rows


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    extra: dict[str, Column] | None = None,
    fan_out: int = FAN_OUT,
    digits: int = DIGITS,
) -> DataFrame:
    """One row per row: ``order``, leaf, subroot, root, levels, and the columns of ``extra``.

    A leaf is the digest of the framed fields. In each group the leaves ascend by ``order`` (null first; ties by leaf,
    so that repeated rows are neighbours). ``levels`` lists the texts of the siblings left and right of the path, from
    the leaf to the root; a level without siblings is a pair of empty texts. Groups ascend by their bytes, the null
    group first; a text of any length is one digest. An empty table gives no rows; other columns are not read.
    """
    own = extra or {}
    leaves = docs.select(
        group_key(group).alias("group"),
        F.col(order).alias("key"),
        digest(*[framed(F.col(f)) for f in fields]).alias("leaf"),
        F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in own.items()]).alias("extra"),
    )
    nodes = ranked(leaves, ["key", "leaf"]).select(
        "group", "rank", "total", F.struct(F.col("leaf").alias("digest"), "key", "extra").alias("node")
    )
    tiers = forest(nodes, fan_out, digits)
    subroots = tiers[-1].select(F.lit("").alias("group"), F.col("group").alias("key"), F.col("node.digest").alias("leaf"))
    over = ranked(subroots, ["key"]).select(
        "group", "rank", "total", F.struct(F.col("leaf").alias("digest"), "key").alias("node")
    )
    upper = forest(over, fan_out, digits)
    root = upper[-1].select("group", F.array().cast(LEVELS).alias("levels"), F.col("node.digest").alias("root"))
    tops = descend(upper, root, ["root"], fan_out, digits).select(
        F.col("node.key").alias("group"), "levels", F.col("node.digest").alias("subroot"), "root"
    )
    rows = descend(tiers, tops, ["subroot", "root"], fan_out, digits)
    return rows.select(
        F.col("node.key").alias(order),
        F.col("node.digest").alias("leaf"),
        "subroot",
        "root",
        "levels",
        *[F.col(f"node.extra.{n}").alias(n) for n in own],
    )


def folded(leaf: str, levels: str = "levels") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(levels, F.col(leaf), lambda own, at: digest(at["left"], own, at["right"]))


def proof_digest(levels: str = "levels") -> Column:
    """Digest of all siblings of a path, level by level from the leaf, left to right."""
    return digest(F.array_join(F.transform(levels, lambda at: F.concat(at["left"], at["right"])), ""))


def verify_tampered(docs: DataFrame) -> DataFrame:
    """The manifest of documents and its check against a copy in which line ends of some texts are deleted.

    A document is tampered with where 2 divides the crc32 of its id (a null id counts as the text ``null``). Returns
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, one row per row of ``docs``.
    """
    cut = F.when(fold_of("doc_id", 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = digest(*[framed(cut if f == "text" else F.col(f)) for f in FIELDS])
    rows = manifest(docs, extra={"now": now}).withColumn("folded_root", folded("now"))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
