"""Merkle manifest of a dataset: a tree of three children for each group, a tree over the groups' roots.

A parent is the SHA-256 of its children's digests, so hashing a run of children passes through
the state before each child's slot. Parents keep a copy of that state for every slot. To fold a
replaced child upwards, the copy is resumed with the replacement and the siblings to its right;
what stands to its left is never hashed again. The proof of a leaf is the siblings of its path.

The rows are numbered once by a range sort. BLOCK consecutive leaves of a group are a complete
subtree, which one task builds; the roots of the blocks are the leaves of the next round, in
which there are BLOCK times fewer. Tasks hold some thousands of digests whatever a group's size,
and groups smaller than a block share a task with their neighbours.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import join_back
from .staging import staged

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARITY = 3
LEVELS = 7
BLOCK = ARITY ** LEVELS  # leaves of the subtree that one task builds
PLACE_BITS = 33          # of monotonically_increasing_id, below the number of the partition


def field(value: Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


# ---- in a task ----

def height(n: int) -> int:
    """Levels above the leaves in a block of a tree of n nodes: all of a small tree, LEVELS of a larger one."""
    levels, left = 0, min(n, BLOCK)
    while left > 1:
        left, levels = -(-left // ARITY), levels + 1
    return LEVELS if n > BLOCK else levels


class Subtree:
    """Digests by level, from the leaves to one root, and for each child the hash state before its slot."""

    def __init__(self, leaves: list[bytes], levels: int):
        self.digests, self.before = [leaves], []
        for _ in range(levels):
            states, parents = [], []
            for i in range(0, len(self.digests[-1]), ARITY):
                state = sha256()
                for child in self.digests[-1][i:i + ARITY]:
                    states.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.before.append(states)
            self.digests.append(parents)

    @property
    def root(self) -> bytes:
        return self.digests[-1][0]

    def siblings(self, slot: int) -> list[tuple[bytes, bytes]]:
        """Siblings to the left and to the right of the path, level by level."""
        out = []
        for level in self.digests[:-1]:
            first = slot - slot % ARITY
            out.append((b"".join(level[first:slot]), b"".join(level[slot + 1:first + ARITY])))
            slot //= ARITY
        return out

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The root with the leaf at the slot replaced."""
        for level, states in zip(self.digests, self.before):
            state = states[slot].copy()
            state.update(digest)
            for right in level[slot + 1:slot - slot % ARITY + ARITY]:
                state.update(right)
            digest, slot = state.hexdigest().encode(), slot // ARITY
        return digest


def _trees(table: pa.Table):
    """(rows of one subtree in order, the subtree) for each tree in the rows of a group."""
    table = table.sort_by([("tree", "ascending"), ("p", "ascending")]).combine_chunks()
    tree, sizes = table.column("tree").to_pylist(), table.column("n").to_pylist()
    at = [i for i in range(len(tree)) if not i or tree[i] != tree[i - 1]]
    for a, b in zip(at, at[1:] + [len(tree)]):
        part = table.slice(a, b - a)
        yield part, Subtree([d.encode() for d in part.column("digest").to_pylist()], height(sizes[a]))


def _block_roots(table: pa.Table) -> pa.Table:
    out = [(t.column("tree")[0].as_py(), t.column("p")[0].as_py() // BLOCK, -(-t.column("n")[0].as_py() // BLOCK), s.root.decode()) for t, s in _trees(table)]
    return pa.table({c: pa.array(v, k) for c, v, k in zip(("tree", "p", "n", "digest"), zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))})


PATH = "array<struct<before: string, after: string>>"
ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _block_paths(table: pa.Table) -> pa.Table:
    parts = []
    for t, s in _trees(table):
        paths = [[{"before": a.decode(), "after": b.decode()} for a, b in s.siblings(i)] for i in range(t.num_rows)]
        parts.append(pa.table({"tree": t.column("tree"), "p": t.column("p"), "n": t.column("n"), "path": pa.array(paths, ARROW_PATH),
                               "root": pa.array([s.root.decode()] + [None] * (t.num_rows - 1), pa.string())}))
    return pa.concat_tables(parts)


def _proofs(rows: pa.Table, tops: pa.Table) -> pa.Table:
    above = {t["tree"]: t for t in tops.to_pylist()}
    parts = []
    for t, s in _trees(rows):
        top = above[t.column("tree")[0].as_py()]
        root = top["root"]
        rest = "".join(x["before"] + x["after"] for x in top["path"]).encode()
        states = [(sha256(x["before"].encode()), x["after"].encode()) for x in top["path"]]
        proof, folded = [], []
        for i, (leaf, changed) in enumerate(zip(t.column("digest").to_pylist(), t.column("changed").to_pylist())):
            own = sha256(b"".join(x for pair in s.siblings(i) for x in pair))
            own.update(rest)
            proof.append(own.hexdigest())
            digest = s.fold(i, (changed or leaf).encode())
            for state, after in states:
                state = state.copy()
                state.update(digest)
                state.update(after)
                digest = state.hexdigest().encode()
            folded.append(digest.decode())
        n = t.num_rows
        parts.append(pa.table({"id": t.column("id"), "leaf": t.column("digest"), "subroot": pa.array([top["subroot"]] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                               "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_())}))
    return pa.concat_tables(parts)


PROOF = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# ---- over tables ----

def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with `pos`, their place from 0 in the given order. Partitions of a range sort are
    numbered by their sizes; only one row for each partition goes through one task."""
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    pos = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # one row for each partition
            .withColumn("pos", pos).drop("_part", "_place", "_before"))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (tree, p, n, digest), n being the nodes of their tree: the path of each node,
    (tree, p, path), and the root of each tree, (tree, digest). A round for every BLOCK-fold."""
    now, up = staged(nodes, "nodes"), F.expr(f"p div {BLOCK}")
    paths = now.select("tree", "p", F.col("p").alias("_up"), F.lit(None).cast(PATH).alias("path"))
    while (now.agg(F.max("n")).first()[0] or 1) > 1:
        made = staged(now.groupBy("tree", up.alias("_up")).applyInArrow(
            _block_paths, f"tree long, p long, n long, path {PATH}, root string"), "paths")
        step = made.select("tree", F.col("p").alias("_up"), F.col("path").alias("_more"))
        paths = staged(paths.join(step, ["tree", "_up"]).select(
            "tree", "p", F.expr(f"_up div {BLOCK}").alias("_up"),
            F.when(F.col("path").isNull(), F.col("_more")).otherwise(F.concat("path", "_more")).alias("path")), "paths")
        now = made.filter("root is not null").select(
            "tree", up.alias("p"), F.expr(f"(n - 1) div {BLOCK} + 1").alias("n"), F.col("root").alias("digest"))
    return paths.select("tree", "p", F.coalesce("path", F.array().cast(PATH)).alias("path")), now.select("tree", "digest")


@dataclass
class Manifest:
    """rows: (id, digest, changed, tree, first, p, n) of every leaf; tops: (tree, first, n, block,
    subroot, root, path) of every block, its path leading from the block's root to the root;
    groups: (group, n_leaves, subroot, root)."""

    rows: DataFrame
    tops: DataFrame
    groups: DataFrame


def _task(p: Column) -> list[Column]:
    """What the rows of one task share: the block of a large tree, or neighbouring small trees."""
    large = F.col("n") > BLOCK
    return [F.when(large, F.col("tree")).otherwise(F.lit(-1)).alias("_g"),
            F.when(large, p).otherwise(F.expr(f"first div {BLOCK}")).alias("_h")]


def manifest(leaves: DataFrame) -> Manifest:
    """Trees over leaves (id, group, digest, changed): `changed` is the digest to fold in place of
    the leaf's own, null for none.

    Leaves of a group ascend by id, null ids first, then by digest, so repeated rows are leaves
    of their own and a repeated run gives the same tree. Groups ascend bytewise, null first.
    A lone leaf is its group's root and a lone group's root is the root. No leaves, no rows.
    """
    leaves = staged(leaves.select(F.col("id").cast("long").alias("id"), F.col("group").cast("string").alias("group"), "digest", "changed"), "leaves")
    order = [F.col(c).asc_nulls_first() for c in ("group", "id", "digest")]
    placed = numbered(leaves.withColumn("_tie", F.monotonically_increasing_id()), [*order, F.col("_tie").asc()])
    trees = staged(placed.groupBy("group").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")), "groups")
    trees = staged(numbered(trees, [F.col("first").asc()]).withColumnRenamed("pos", "tree"), "trees")
    rows = staged(join_back(placed, trees, ["group"]).select(
        "id", "digest", "changed", "tree", "first", "n", (F.col("pos") - F.col("first")).alias("p")), "rows")
    block = F.expr(f"p div {BLOCK}")
    roots = rows.select("tree", "p", "n", "digest", *_task(block)).groupBy("_g", "_h").applyInArrow(_block_roots, "tree long, p long, n long, digest string")
    inner, subroots = climb(roots)
    subroots = staged(subroots.select("tree", F.col("digest").alias("subroot")), "subroots")
    outer, root = climb(subroots.crossJoin(F.broadcast(subroots.agg(F.count(F.lit(1)).alias("n")))).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("p"), "n", F.col("subroot").alias("digest")))
    whole = trees.join(subroots, "tree").join(outer.select(F.col("p").alias("tree"), F.col("path").alias("_outer")), "tree").crossJoin(
        F.broadcast(root.select(F.col("digest").alias("root"))))  # one row
    tops = inner.withColumnRenamed("p", "block").join(whole, "tree").select(
        "tree", "first", "n", "block", "subroot", "root", F.concat("path", "_outer").alias("path"))
    return Manifest(rows, tops, whole.select("group", F.col("n").alias("n_leaves"), "subroot", "root"))


def audited(m: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for each leaf: the digest of
    the siblings on its path, and the root that its changed digest (else its own) folds to with them."""
    block = F.expr(f"p div {BLOCK}")
    rows = m.rows.select("id", "digest", "changed", "tree", "p", "n", *_task(block))
    tops = m.tops.select("tree", "subroot", "root", "path", *_task(F.col("block")))
    return rows.groupBy("_g", "_h").cogroup(tops.groupBy("_g", "_h")).applyInArrow(_proofs, PROOF)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents by source. Of documents whose id as decimal text has an even CRC-32,
    the changed digest is that of the text without line feeds; a null id is never changed.
    Nulls in any column have a digest of their own, an empty text another. Further columns are no part of it."""
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered & F.contains("text", F.lit("\n")), leaf_digest(*kept, F.translate("text", "\n", "")))
    return docs.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), leaf_digest(*kept, F.col("text")).alias("digest"), changed.alias("changed"))
