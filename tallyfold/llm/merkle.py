"""A Merkle manifest of a dataset, with inclusion proofs by pointer jumping.

Every row is a leaf. The leaves of a group, in order, are hashed in pairs up to the group's subroot; the subroots, in
order, likewise up to the root. A proof is the siblings on a leaf's way to the root. A node first holds one segment, its
own sibling, and points to its parent. Each round joins the nodes with the nodes that they point to: a node takes over the
segment of that ancestor behind its own and points twice as far. So a tree of height h takes log2(h) self-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch

#: Levels that one step hashes; a step reads runs of 2 ** STEP nodes.
STEP = 10
#: At most 2 ** FAN rows meet one copy of an ancestor; further away, the ancestor is copied.
FAN = 12
DIGEST = 32  # bytes


def field(value: Column) -> Column:
    """Byte count, colon and value; a dash for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in hexadecimal, of the fields one after another."""
    return F.sha2(F.concat(*map(field, values)), 256)


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def sibling_exists(idx: Column, n: Column, level: Column) -> Column:
    """Whether the node above leaf ``idx`` at ``level`` has another one in its run."""
    def up(x):
        return F.call_function("shiftright", x, level.cast("int"))
    return up(idx).bitwiseXOR(F.lit(1).cast("long")) <= up(n - 1)


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with idx, their place in their group from 0, and n, the size of the group.

    Rows are range-partitioned by group and order, so a group of any size is spread over partitions; a place is the place
    within the partition plus the rows of the group in earlier partitions.
    """
    spread = rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id())
    placed = scratch.keep(spread, f"placed-{group}")
    sizes = placed.groupBy(group, "part").agg(F.count("*").alias("held"))
    # As many rows as the group has partitions.
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"),
                          F.sum("held").over(whole).alias("n"))
    within = Window.partitionBy(group, "part").orderBy(*order)
    out = placed.join(starts, [group, "part"]).withColumn("idx", F.col("start") + F.row_number().over(within) - 1)
    return scratch.keep(out.select(*rows.columns, "idx", "n"), f"numbered-{group}")


def _tree_of_run(hashes: Column, levels: Column) -> Column:
    """The nodes of a run, level by level, up to ``levels`` levels above."""
    def above(below):
        pairs = F.sequence(F.lit(0), F.call_function("shiftright", F.size(below) - 1, F.lit(1)))
        return F.transform(pairs, lambda i: F.sha2(
            F.concat(F.get(below, i * 2), F.coalesce(F.get(below, i * 2 + 1), F.lit(""))), 256))

    start = F.array(hashes)
    grown = F.aggregate(F.sequence(F.lit(1), levels), start,
                        lambda done, _: F.concat(done, F.array(above(F.element_at(done, -1)))))
    return F.when(levels > 0, grown).otherwise(start)


def built(leaves: DataFrame, group: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Nodes below the top, as (group, level, idx, seg), the tops, as (group, n, top), and the greatest height.

    ``leaves`` has idx, n and hash. ``seg`` is the sibling's digest as bytes, none if a node is alone. Each step hashes
    runs of at most 2 ** STEP neighbouring nodes, so its groups are bounded and there are few steps.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    tall = max(0, (most - 1).bit_length())
    current = leaves.select(group, "idx", F.col("n").alias("leaves"), "n", "hash")
    tops, nodes = [current.where("n = 1")], []
    for base in range(0, tall, STEP):
        run = F.shiftright("idx", STEP).alias("run")
        runs = current.where("n > 1").groupBy(group, "leaves", "n", run).agg(
            F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
        up = F.least(F.lit(STEP), height(F.col("n")))
        runs = runs.select(group, "leaves", "n", "run", up.alias("up"),
                           _tree_of_run(F.transform("kids", lambda x: x["hash"]), up).alias("tree"))
        runs = scratch.keep(runs, f"runs-{group}-{base}")
        below = F.transform(F.slice("tree", F.lit(1), F.col("up")), lambda hashes, k: F.transform(hashes, lambda _, i: F.struct(
            (k + base).alias("level"),
            (F.call_function("shiftleft", F.col("run"), F.lit(STEP) - k) + i).alias("idx"),
            F.coalesce(F.unhex(F.get(hashes, i.bitwiseXOR(F.lit(1)))), F.lit(bytearray())).alias("seg"))))
        nodes.append(runs.select(group, F.inline(F.flatten(below))))
        count = F.call_function("shiftright", F.col("n") - 1, F.col("up").cast("int")) + 1
        current = runs.select(group, F.col("run").alias("idx"), "leaves", count.alias("n"),
                              F.get(F.element_at("tree", -1), F.lit(0)).alias("hash"))
        tops.append(current.where("n = 1"))
    ended = tops[0]
    for more in tops[1:]:
        ended = ended.unionByName(more)
    if not nodes:
        nodes = [current.limit(0).select(group, F.lit(0).alias("level"), "idx", F.lit(bytearray()).alias("seg"))]
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    return every, ended.select(group, F.col("leaves").alias("n"), F.col("hash").alias("top")), tall


def jumped(nodes: DataFrame, group: str, tall: int, scratch: Scratch) -> DataFrame:
    """(group, idx, seg) of the leaves that have parents; seg holds all siblings up to the top, the lowest first.

    In the round of distance d only nodes whose level is a multiple of d are pointed to or still on their way. At most
    2 ** d nodes point to the same ancestor; beyond 2 ** FAN of them it is copied, and each copy meets its share.
    """
    d, names = 1, []
    while d < tall:
        fan = min(d, FAN)
        left = nodes.where(F.col("level") % (2 * d) == 0).withColumn("meet", F.shiftright("idx", fan))
        right = nodes.where(F.col("level") % (2 * d) == d)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((1 << d - fan) - 1).cast("long"))).alias("copy")
        right = right.select(group, (F.col("level") - d).alias("level"), F.shiftleft("idx", d - fan).alias("first"),
                             F.col("seg").alias("more"), copies)
        right = right.select(group, "level", (F.col("first") + F.col("copy")).alias("meet"), "more")
        joined = left.join(right, [group, "level", "meet"], "left")
        seg = F.concat("seg", F.coalesce("more", F.lit(bytearray())))
        nodes = scratch.keep(joined.select(group, "level", "idx", seg.alias("seg")), f"jump-{group}-{d}")
        scratch.drop(*names)
        names = [f"jump-{group}-{d}"]
        d *= 2
    return nodes.select(group, "idx", "seg")


def folded(start: Column, idx: Column, n: Column, seg: Column) -> Column:
    """The top that follows from a leaf's digest, its place and its siblings."""
    def step(state, k):
        met = sibling_exists(idx, n, k)
        other = F.lower(F.hex(F.substring(seg, state["used"] * DIGEST + 1, F.lit(DIGEST))))
        right = F.call_function("shiftright", idx, k).bitwiseAND(F.lit(1).cast("long")) == 1
        run = F.when(~met, state["hash"]).when(right, F.concat(other, state["hash"])).otherwise(F.concat(state["hash"], other))
        return F.struct(F.sha2(run, 256).alias("hash"), (state["used"] + met.cast("int")).alias("used"))

    levels = F.when(n > 1, F.sequence(F.lit(0), height(n) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, F.struct(start.alias("hash"), F.lit(0).alias("used")), step, lambda state: state["hash"])


def proofs(rows: DataFrame, group: Column, order: list[str], leaf: str, scratch: Scratch | None = None) -> DataFrame:
    """``rows`` with subroot, root and what leads to them: idx, n, siblings; top_idx, top_n, top_siblings.

    ``leaf`` names the digest of a row, in hexadecimal. Leaves of a group ascend by ``order`` and then by digest, groups by
    their value, nulls first in both. Siblings are bytes, 32 each, the lowest level first. Names of the new columns and
    ``grp`` and ``part`` must be free. A table without rows gives none.
    """
    scratch = scratch or Scratch(rows.sparkSession, "merkle")
    key = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))
    leaves = numbered(rows.withColumn("grp", key), "grp", [*order, leaf], scratch)
    nodes, tops, tall = built(leaves.withColumn("hash", F.col(leaf)), "grp", scratch)
    ways = jumped(nodes, "grp", tall, scratch)
    subroots = numbered(tops.select(F.lit(0).alias("all"), "grp", F.col("n").alias("leaves"), F.col("top").alias("hash")),
                        "all", ["grp"], scratch)
    nodes, top, tall = built(subroots, "all", scratch)
    found = top.first()
    root = F.lit(found["top"] if found else None).cast("string")
    last = subroots.join(jumped(nodes, "all", tall, scratch).drop("all"), "idx", "left")
    # One row for each 2 ** FAN leaves of a group, so that no task gets all leaves of a large one.
    last = last.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("leaves") - 1, FAN))).alias("meet"),
                       F.col("hash").alias("subroot"), F.col("idx").alias("top_idx"), F.col("n").alias("top_n"),
                       F.coalesce("seg", F.lit(bytearray())).alias("top_siblings"))
    whole = leaves.join(ways, ["grp", "idx"], "left").withColumn("meet", F.shiftright("idx", FAN)).join(last, ["grp", "meet"])
    return whole.select(*rows.columns, "idx", "n", "subroot", F.coalesce("seg", F.lit(bytearray())).alias("siblings"),
                        "top_idx", "top_n", "top_siblings", root.alias("root"))


def proof_digest(siblings: Column, top_siblings: Column) -> Column:
    """SHA-256 of all siblings as hexadecimal text, from the leaf to the root."""
    return F.sha2(F.lower(F.hex(F.concat(siblings, top_siblings))), 256)


def check_proof(leaf: Column) -> Column:
    """The root that follows from a leaf's digest and the proof in its row."""
    subroot = folded(leaf, F.col("idx"), F.col("n"), F.col("siblings"))
    return folded(subroot, F.col("top_idx"), F.col("top_n"), F.col("top_siblings"))


def manifest(docs: DataFrame, changed: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    A leaf is the digest of doc_id, source, lang, n_chars and text; groups are languages, in the order of doc_id. Where
    ``changed`` holds, one is added to n_chars before the leaf is checked against its proof; a null n_chars stays. Null
    languages are a group of their own, the first. Rows without doc_id come first in their group; rows that share a doc_id
    follow each other by digest. Empty texts are texts, null ones a dash. Other columns are not read.
    """
    def leaf(n_chars):
        return leaf_digest(*[n_chars if c == "n_chars" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])

    more = F.when(F.coalesce(changed, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), leaf(more).alias("seen"))
    found = proofs(rows, F.col("lang"), ["doc_id"], "leaf").withColumn("folded_root", check_proof(F.col("seen")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings"), F.col("top_siblings")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
