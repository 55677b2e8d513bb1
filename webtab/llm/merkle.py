"""A Merkle manifest of a dataset, and proofs for all its rows by an octopus multiproof.

Every row is a leaf, the SHA-256 of its fields. The leaves of a group (a language, say) in the order of their key form a
tree in which ``FANOUT`` neighbours become their hash; the roots of the groups, in the order of the groups, form one more
tree above. A manifest is a folder of two tables: ``leaves`` (place of each row in its tree) and ``nodes`` (every node, by tree,
level and index).

Proofs are made for a whole block of neighbouring leaves at once. Walking up from the leaves that are to be proved, a block
lists the siblings that it can neither hold nor derive: the union over all its proofs without repeats. These nodes
are fetched once by a join; with them the block derives the interior nodes its proofs share, and cuts each proof out of
the joined digests of its runs. Blocks are aligned ranges of ``FANOUT ** BLOCK_LEVELS`` leaves, so a group that owns most of the
rows is many blocks, and what a task holds is bounded.

Places come from a range sort over group, key and leaf: the sort numbers rows in each part, and the counts of parts before it give
the offset; no group is sorted in one task.

Cases: a null group is a group of its own and comes first; null keys come first in their group; rows that share a key are ordered
by their leaf, and rows that agree in everything are interchangeable; an empty text is a field of length zero, a null field
is ``-``; a group of one has its leaf as root, and so has a dataset of one group; its proof is empty if it is the only row; an empty
table gives empty tables and no root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtab.session import cut

FANOUT = 8
BLOCK_LEVELS = 4
BLOCK = FANOUT ** BLOCK_LEVELS
HEX = 64
TOP = "top"     # the tree over the groups; groups are named '' (null) or '=' and their value
NODE = "tree string, level int, index long, digest string"
WANTED = "home string, block long, tree string, level int, index long"
PROOF = "key long, leaf string, subroot string, proof string, folded_root string"


def sha(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


# ---- leaves ------------------------------------------------------------------------
def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def tree_of(group: Column) -> Column:
    """A name for each group, null included, in the order of the groups (bytes of UTF-8, null first)."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


# ---- places ------------------------------------------------------------------------
def placed(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree``, and ``n``, its size. ``rows`` must be a written table."""
    keys = [F.col("tree"), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("_part", F.shiftright("_at", 33)), label)
    # a part holds a tree in one run; one row for each tree and part
    runs = cut(ranged.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")), f"{label}-runs")
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                          F.sum("_n").over(whole).alias("n"))
    return (ranged.join(offsets, ["tree", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_shift"))


# ---- trees -------------------------------------------------------------------------
def counts(n: int) -> list[int]:
    """Nodes of each level, from the leaves to the root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FANOUT))
    return out


def _rise(level: int):
    """The nodes above a block of ``digest``s of a level, up to the block's own root."""
    def run(block: pa.Table) -> pa.Table:
        order = np.argsort(block["pos"].to_numpy())
        digests = [x.encode() for x in block["digest"].take(order).to_pylist()]
        tree, n, first = block["tree"][0].as_py(), block["n"][0].as_py(), int(block["pos"].to_numpy().min())
        levels, index, found = [], [], []
        for up, size in enumerate(counts(n)[1:BLOCK_LEVELS + 1], 1):
            digests = [sha(b"".join(digests[k:k + FANOUT])) for k in range(0, len(digests), FANOUT)]
            first //= FANOUT
            levels += [level + up] * len(digests)
            index += range(first, first + len(digests))
            found += digests
        return pa.table({"tree": pa.array([tree] * len(found), pa.string()), "level": pa.array(levels, pa.int32()),
                         "index": pa.array(index, pa.int64()), "digest": pa.array([d.decode() for d in found], pa.string())})
    return run


def interior(leaves: DataFrame, label: str) -> DataFrame:
    """All nodes above ``leaves`` (tree, pos, n, digest), some levels a round."""
    rounds, level = [], 0
    while leaves.where("n > 1").limit(1).count():
        grown = cut(leaves.where("n > 1").select("tree", "pos", "n", "digest", F.expr(f"pos div {BLOCK}").alias("block"))
                    .groupBy("tree", "block").applyInArrow(_rise(level), NODE), f"{label}-nodes")
        rounds.append(grown)
        level += BLOCK_LEVELS
        # the roots of this round's blocks, where their tree goes on
        above = leaves.where((F.col("n") > BLOCK) & (F.col("pos") % BLOCK == 0)).select(
            "tree", F.expr(f"pos div {BLOCK}").alias("index"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"))
        leaves = cut(grown.where(F.col("level") == level).join(above, ["tree", "index"])
                     .select("tree", F.col("index").alias("pos"), "n", "digest"), f"{label}-level")
    empty = leaves.limit(0).select("tree", F.lit(0).alias("level"), F.col("pos").alias("index"), "digest")
    return reduce(DataFrame.unionByName, rounds, empty)


def write_manifest(rows: DataFrame, out: str, fields: list[str], group_col: str, key_col: str, claimed: Column | None = None) -> None:
    """Write the leaves and nodes of ``rows``. ``claimed`` is a leaf to be held against the tree later; without it the leaf."""
    own = leaf([F.col(f) for f in fields])
    table = cut(rows.select(tree_of(F.col(group_col)).alias("tree"), F.col(key_col).cast("long").alias("key"), own.alias("digest"),
                            (own if claimed is None else claimed).alias("claimed"), F.monotonically_increasing_id().alias("row")), "leaf-digests")
    # the row number divides rows that agree in all else
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]
    leaves = cut(placed(table, order, "leaves").drop("row"), "leaves")
    nodes = cut(interior(leaves, "tree"), "nodes")
    ends = nodes.select("tree", "level", "digest").unionByName(
        leaves.where("n = 1").select("tree", F.lit(0).alias("level"), "digest"))
    roots = cut(ends.groupBy("tree").agg(F.max_by("digest", "level").alias("digest")).withColumnRenamed("tree", "group"), "subroots")
    top = cut(placed(roots.withColumn("tree", F.lit(TOP)), [F.col("group")], "groups"), "groups")
    above = interior(top, "top")
    bottom = top.select("tree", F.lit(0).alias("level"), F.col("pos").alias("index"), "digest")
    nodes.unionByName(bottom).unionByName(above).write.parquet(f"{out}/nodes")
    place = top.select(F.col("group").alias("tree"), F.col("pos").alias("group_pos"), F.col("n").alias("groups"))
    # the place of a group is sent along with its leaves; a hot group is split over tasks by adaptive execution
    leaves.join(place, "tree").write.parquet(f"{out}/leaves")


def root(spark: SparkSession, out: str) -> str | None:
    """The root of a manifest."""
    found = spark.read.schema(NODE).parquet(f"{out}/nodes").where(F.col("tree") == TOP).orderBy(F.desc("level")).limit(1).collect()
    return found[0]["digest"] if found else None


# ---- proofs ------------------------------------------------------------------------
def missing(n: int, known: np.ndarray) -> list[tuple[int, int]]:
    """(level, index) of every node that proofs for the leaves ``known`` of a tree of ``n`` need and cannot derive."""
    out = []
    for level, size in enumerate(counts(n)[:-1]):
        parents = np.unique(known // FANOUT)
        children = (parents[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        out += [(level, int(k)) for k in np.setdiff1d(children[children < size], known)]
        known = parents
    return out


def _wanted(block: pa.Table) -> pa.Table:
    first = {c: block[c][0].as_py() for c in ("tree", "block", "n", "group_pos", "groups")}
    own = missing(first["n"], np.unique(block["pos"].to_numpy()))
    top = missing(first["groups"], np.asarray([first["group_pos"]]))
    m, found = len(own) + len(top), own + top
    return pa.table({"home": pa.array([first["tree"]] * m, pa.string()), "block": pa.array([first["block"]] * m, pa.int64()),
                     "tree": pa.array([first["tree"]] * len(own) + [TOP] * len(top), pa.string()),
                     "level": pa.array([x[0] for x in found], pa.int32()), "index": pa.array([x[1] for x in found], pa.int64())})


def derive(n: int, known: dict[int, bytes], fetched: dict[tuple[int, int], bytes]) -> tuple[list[dict[int, bytes]], bytes]:
    """The joined digests of every run that the proofs of ``known`` leaves pass, level by level, and the root."""
    levels = []
    for level, size in enumerate(counts(n)[:-1]):
        runs = {}
        for parent in sorted({k // FANOUT for k in known}):
            children = range(parent * FANOUT, min(size, (parent + 1) * FANOUT))
            runs[parent] = b"".join([known[k] if k in known else fetched[level, k] for k in children])
        levels.append(runs)
        known = {parent: sha(run) for parent, run in runs.items()}
    return levels, next(iter(known.values()))


def siblings(levels: list[dict[int, bytes]], pos: int) -> Iterator[tuple[bytes, bytes]]:
    """The digests before and after a leaf's ancestor in its run, level by level."""
    for runs in levels:
        run, at = runs[pos // FANOUT], pos % FANOUT * HEX
        yield run[:at], run[at + HEX:]
        pos //= FANOUT


def _expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
    first = {c: leaves[c][0].as_py() for c in ("tree", "n", "group_pos", "groups")}
    parts = [{}, {}]
    for tree, level, index, digest in zip(*(nodes[c].to_pylist() for c in ("tree", "level", "index", "digest")), strict=True):
        parts[tree == TOP][level, index] = digest.encode()
    pos, digests = leaves["pos"].to_pylist(), [d.encode() for d in leaves["digest"].to_pylist()]
    levels, subroot = derive(first["n"], dict(zip(pos, digests, strict=True)), parts[0])
    top, _ = derive(first["groups"], {first["group_pos"]: subroot}, parts[1])
    above = list(siblings(top, first["group_pos"]))
    proofs, folded = [], []
    for k, claim in zip(pos, leaves["claimed"].to_pylist(), strict=True):
        path = [*siblings(levels, k), *above]
        node = claim.encode()
        for left, right in path:
            node = sha(left + node + right)
        proofs.append(b"".join([x for pair in path for x in pair]).decode())
        folded.append(node.decode())
    return pa.table({"key": leaves["key"], "leaf": leaves["digest"], "subroot": pa.array([subroot.decode()] * len(pos), pa.string()),
                     "proof": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


def prove(spark: SparkSession, out: str, wanted: Column | None = None) -> DataFrame:
    """Proofs for the leaves of a manifest that meet ``wanted``, or for all of them.

    Returns the key (named ``doc_id``), leaf, subroot, proof (the digests of the siblings, level by level, left to right,
    joined) and ``folded_root``, what the claimed leaf and the proof fold to.
    """
    leaves = spark.read.parquet(f"{out}/leaves")
    nodes = spark.read.schema(NODE).parquet(f"{out}/nodes")
    leaves = (leaves if wanted is None else leaves.where(wanted)).withColumn("block", F.expr(f"pos div {BLOCK}"))
    ends = spark.read.parquet(f"{out}/leaves").select("tree", F.lit(0).alias("level"), F.col("pos").alias("index"), "digest")
    coordinates = leaves.drop("key", "digest", "claimed").groupBy("tree", "block").applyInArrow(_wanted, WANTED)
    stored = nodes if wanted is None else nodes.unionByName(ends)
    fetched = (coordinates.join(stored, ["tree", "level", "index"]).withColumn("home_block", F.col("block")))
    return (leaves.groupBy("tree", "block").cogroup(fetched.groupBy("home", "home_block"))
            .applyInArrow(_expand, PROOF).withColumnRenamed("key", "doc_id"))
