"""Merkle manifest of a dataset with one proof per row, found by pointer jumping over stored tables.

Leaves of a group stand in the order of their ids; eight consecutive nodes make a parent until one is left, the
group's subroot. Subroots, ordered by group, make the root in the same way. Every node first holds the siblings
that its parent needs (one segment) and points at its parent. A self-join along the pointers concatenates the
segments and doubles the distance, so a proof of d levels takes log2(d) joins.

Edge cases: null values enter the hash as ``-``; rows of a null group are a group of their own, before all others;
null ids come first in their group; rows that repeat an id stand side by side in the order of their leaves, each
with a proof of its own; an empty table gives an empty manifest; other columns of the table are not looked at and
may bear any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import stored

FAN_OUT = 8
#: A side of a join is broadcast when its rows, counted before, take no more than this.
BROADCAST_BYTES = 8 << 20
_SEGMENT_BYTES = 32 * FAN_OUT
#: Nodes of a level that one task makes runs of. Levels shrink eightfold, so small ones are not dealt over many tasks and files.
NODES_A_TASK = 8192
#: Tree number of the nodes above the subroots.
_TOP = -1
_NO_SEGMENTS = "array<struct<before: binary, after: binary>>"


def field(value: Column, is_text: bool) -> Column:
    """A value as hashed: its length in bytes, a colon, the value; null is a dash."""
    text = value if is_text else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(df: DataFrame, columns: list[str], instead: dict[str, Column] | None = None) -> Column:
    """Lower-case hex SHA-256 over the given columns of a row; ``instead`` replaces columns by other values."""
    kinds, instead = dict(df.dtypes), instead or {}
    return F.sha2(F.concat(*(field(instead.get(c, df[c]), kinds[c] == "string") for c in columns)), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _combined(digests: Column) -> Column:
    """Digest of a node from its children's digests (array of binary)."""
    text = F.array_join(F.transform(digests, _hex), "")
    return F.unhex(F.sha2(text, 256))


def numbered(df: DataFrame, order: list[Column], label: str) -> tuple[DataFrame, int]:
    """``df`` stored with ``place``, its row number from 0 in the given order, and the number of rows.

    Ranges of the order are sorted apart. Rows that tie are dealt by their place in the input, so that a key
    which many rows share is spread over several ranges. The driver sees one count per range.
    """
    tie = F.monotonically_increasing_id()
    ranged = df.withColumn("_tie", tie).repartitionByRange(*order, F.col("_tie"))
    inside = ranged.sortWithinPartitions(*order, F.col("_tie")).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    rows = stored(inside, label)
    part = F.shiftright("_at", 33)
    starts, total = [], 0
    for r in rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect():
        starts.append((r["_part"], total))
        total += r["n"]
    if not starts:
        return rows.withColumn("place", F.lit(0).cast("long")).drop("_at"), 0
    first = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    joined = rows.withColumn("_part", part).join(F.broadcast(first), "_part")
    return joined.withColumn("place", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_start"), total


def _node(tree: Column, level: int | Column, at: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))


def _levels(nodes: DataFrame, most: int, total: int, trees: int, label: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of each level and the last node of each tree.

    ``nodes``: ``tree``, ``at`` (place in the level), ``n`` (nodes of the tree's level), ``digest`` and ``kept``.
    A run holds up to eight consecutive nodes as ``run``, and its parent's ``digest``. ``most``: nodes of the largest tree; ``total``: nodes of
    all ``trees`` trees.
    """
    runs, done, level = [], [nodes.filter("n = 1")], 0
    while most > 1:
        member = F.struct("at", "digest", "kept")
        grouped = (
            nodes.filter("n > 1")
            .groupBy("tree", F.shiftright("at", 3).alias("up"), "n")
            .agg(F.array_sort(F.collect_list(member)).alias("run"))
            .withColumn("digest", _combined(F.col("run.digest")))
        )
        runs.append(stored(grouped.coalesce(-(-total // NODES_A_TASK)), f"{label}-{level}"))
        parents = ("tree", F.col("up").alias("at"), F.shiftright(F.col("n") + (FAN_OUT - 1), 3).alias("n"), "digest")
        nodes = runs[-1].select(*parents, F.lit(None).cast(nodes.schema["kept"].dataType).alias("kept"))
        done.append(nodes.filter("n = 1"))
        most, total, level = -(-most // FAN_OUT), total // FAN_OUT + trees, level + 1
    return runs, done


def _pointers(runs: DataFrame, level: int, last_of_tree: Column) -> DataFrame:
    """Every node of a level with its parent and the siblings that the parent's digest needs."""
    one = runs.select("tree", "up", "n", "run.digest", F.posexplode("run").alias("i", "member"))
    before = F.slice("digest", 1, F.col("i"))
    after = F.slice("digest", F.col("i") + 2, F.size("digest") - F.col("i") - 1)
    joined = lambda part: F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x))
    return one.select(
        _node(F.col("tree"), level, F.col("member.at")).alias("node"),
        F.when(F.col("n") <= FAN_OUT, last_of_tree).otherwise(_node(F.col("tree"), level + 1, F.col("up"))).alias("parent"),
        F.array(F.struct(joined(before).alias("before"), joined(after).alias("after"))).alias("siblings"),
        F.col("member.digest").alias("digest"),
        F.col("member.kept").alias("kept"),
    )


def _jump(pointers: DataFrame, targets: DataFrame, rows: int, reach: int) -> DataFrame:
    """Follow every pointer once: the target's segments are appended, its own pointer taken over."""
    ahead = targets.select(F.col("node").alias("_node"), F.col("parent").alias("_next"), F.col("siblings").alias("_more"))
    if rows * (100 + reach * _SEGMENT_BYTES) <= BROADCAST_BYTES:
        ahead = F.broadcast(ahead)
    joined = pointers.join(ahead, F.col("parent") == F.col("_node"), "left")
    return joined.select(
        "node",
        F.col("_next").alias("parent"),
        F.when(F.col("_more").isNull(), F.col("siblings")).otherwise(F.concat("siblings", "_more")).alias("siblings"),
        "digest",
        "kept",
    )


def _above(leaves: int, level: int) -> int:
    """Nodes of a tree at a level or above it."""
    count = 0
    while leaves > 1:
        leaves, level = -(-leaves // FAN_OUT), level - 1
        count += leaves if level <= 0 else 0
    return count


def manifest(
    docs: DataFrame, columns: list[str], id_column: str = "doc_id", group: str = "lang", keep: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, group, ``position`` in the group, ``leaf``, ``siblings``, ``subroot``, ``root``.

    ``columns`` are hashed in this order. ``siblings`` is the proof: bottom-up, the digests (32 bytes each) before and after
    the node in its run. ``keep`` adds columns computed from a row of ``docs``; only digests, ids and these are shuffled.
    """
    keep = keep or {}
    leaves = docs.select(
        docs[id_column].alias("id"),
        docs[group].alias("grp"),
        F.unhex(row_digest(docs, columns)).alias("digest"),
        F.struct(*(v.alias(k) for k, v in keep.items()), F.lit(0).alias("_")).alias("more"),
    )
    placed, total = numbered(leaves, [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest")], "merkle-leaves")
    groups = stored(placed.groupBy("grp").agg(F.min("place").alias("first"), F.count("*").alias("n")), "merkle-groups")
    groups, n_groups = numbered(groups, [F.col("first")], "merkle-order")
    groups = groups.select(F.col("grp").alias("_grp"), "first", "n", F.col("place").alias("tree"))
    most = groups.agg(F.max("n")).first()[0] or 0
    few = n_groups <= BROADCAST_BYTES // 1024
    placed = placed.join(F.broadcast(groups) if few else groups, F.col("grp").eqNullSafe(F.col("_grp")))
    nodes = placed.select(
        "tree", (F.col("place") - F.col("first")).alias("at"), "n", "digest", F.struct("id", "grp", "more").alias("kept")
    )
    runs, done = _levels(nodes, most, total, n_groups, "merkle-level")
    subroots = stored(reduce(DataFrame.unionByName, [d.select("tree", "digest") for d in done]), "merkle-subroots")

    above = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(n_groups).cast("long").alias("n"), "digest"
    ).withColumn("kept", F.lit(None).cast(nodes.schema["kept"].dataType))
    top_runs, top_done = _levels(above, n_groups, n_groups, 1, "merkle-top")
    last = reduce(DataFrame.unionByName, [d.select("digest") for d in top_done]).first()
    root = last["digest"].hex() if last else None

    ends = F.lit(None).cast("struct<tree: bigint, level: int, at: bigint>")
    subroot_node = _node(F.lit(_TOP), 0, F.col("tree")) if n_groups > 1 else ends
    pointers = [_pointers(r, k, subroot_node) for k, r in enumerate(runs)]
    pointers += [_pointers(r, k, ends) for k, r in enumerate(top_runs)]
    alone = nodes.filter("n = 1").select(
        _node(F.col("tree"), 0, F.col("at")).alias("node"), subroot_node.alias("parent"), F.array().cast(_NO_SEGMENTS).alias("siblings"), "digest", "kept"
    )
    depth = len(runs) + len(top_runs)
    trees = [r["n"] for r in groups.select("n").collect()] if few else [total]
    reached, step = reduce(DataFrame.unionByName, [*pointers, alone]), 1
    while step <= depth:
        # Pointers span up to `step` levels, so only nodes that far up, or above the subroots, are pointed at.
        far = (F.col("node.level") >= step) | (F.col("node.tree") == _TOP)
        most_rows = sum(_above(n, step) for n in trees) + 2 * n_groups + (0 if few else n_groups * depth)
        reached = _jump(reached, reached.filter(far), most_rows, step)
        step *= 2
        needed = F.col("kept").isNotNull() | (F.col("node.level") >= step) | (F.col("node.tree") == _TOP)
        reached = stored(reached.filter(needed), "merkle-reach")

    leaf_rows = reached.filter(F.col("kept").isNotNull())
    tops = subroots.select(F.col("tree").alias("_tree"), _hex(F.col("digest")).alias("subroot"))
    joined = leaf_rows.join(F.broadcast(tops) if few else tops, F.col("node.tree") == F.col("_tree"))
    return joined.select(
        F.col("kept.id").alias(id_column),
        F.col("kept.grp").alias(group),
        F.col("node.at").alias("position"),
        _hex(F.col("digest")).alias("leaf"),
        "siblings",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        *(F.col("kept.more")[k].alias(k) for k in keep),
    )


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf (hex) and its proof lead to."""
    return F.aggregate(siblings, leaf, lambda node, s: F.sha2(F.concat(_hex(s["before"]), node, _hex(s["after"])), 256))


def proof_digest(siblings: Column) -> Column:
    """Digest of a proof: all siblings, bottom-up and left to right."""
    return F.sha2(_hex(F.aggregate(siblings, F.lit(b""), lambda a, s: F.concat(a, s["before"], s["after"]))), 256)
