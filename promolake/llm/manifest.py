"""Merkle manifest of a dataset: a digest of every row, trees of these by key, and a proof for every row.

A leaf is the sha256 of the row's columns, `-` for null, else UTF-8 byte count, `:`, value.  The leaves of one key value ascend by
the order column; of a level's nodes every two consecutive ones become the digest of their digests (as hex text), a last single
one the digest of its own.  What remains is the subroot of the key value; subroots, null first and then bytewise, give the root in
the same way.

The trees are traversed by aligned blocks of 4096 leaves.  Within a block the subtrees of SUBTREE levels that hold the
current leaf stand stacked (existing), and beside each its right neighbour (desired) grows by one leaf a step, so that it is whole
when the leaf moves on; paths come out leaf by leaf, and no more than two subtrees a layer are in memory.  The roots of
the blocks are the leaves of the next round, by blocks again, until each tree is one node; the proofs of these upper rounds are joined
to the rows of each block at the end.

Rows: null key values are a tree of their own; rows of equal key and order stand by their digests, so repeated rows give equal leaves
side by side, each with its proof.  Empty tables give empty results.  Texts of any length are digested whole by Spark.  Columns that
are not named take no part."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shelf
from .numbering import numbered

#: Leaves of a block.
BLOCK = 4096
#: Levels of a stacked subtree.
SUBTREE = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts: bytes) -> bytes:
    """Lowercase hex of the sha256 of the parts."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class Growing:
    """A subtree of one layer while its leaves arrive: the nodes of heights low to top - 1, by height and place in the subtree.

    `stack` has at most one node a height that waits for its right neighbour."""

    def __init__(self, low: int, top: int):
        self.low, self.top = low, top
        self.nodes: list[list[bytes]] = [[] for _ in range(low, top)]
        self.stack: list[bytes | None] = [None] * (top + 1)
        self.root: bytes | None = None

    def _keep(self, height: int, node: bytes) -> None:
        if self.low <= height < self.top:
            self.nodes[height - self.low].append(node)

    def add(self, leaf: bytes) -> None:
        height, node = 0, leaf
        while True:
            self._keep(height, node)
            if height == self.top:
                self.root = node
                return
            left, self.stack[height] = self.stack[height], None
            if left is None:
                self.stack[height] = node
                return
            node, height = H(left, node), height + 1

    def close(self) -> None:
        """No leaf follows: last single nodes become parents alone."""
        if self.root is not None:
            return
        carried = None
        for height in range(self.top):
            left, self.stack[height] = self.stack[height], None
            if left is None and carried is None:
                continue
            carried = H(*(x for x in (left, carried) if x is not None))
            self._keep(height + 1, carried)
        self.root = carried


def height_of(n: int) -> int:
    """Levels between n leaves and one node."""
    return max(0, n - 1).bit_length()


def traverse(leaves: list[bytes], levels: int, step: int = SUBTREE) -> tuple[bytes, Iterator[list[bytes]]]:
    """The root over `levels` levels and, leaf by leaf, the siblings from the lowest level up (b"" where a node is alone)."""
    m = len(leaves)
    layers = [(low, min(low + step, levels)) for low in range(0, levels, step)]

    def whole(low: int, top: int, at: int) -> Growing:
        tree = Growing(low, top)
        for leaf in leaves[at << top : (at + 1) << top]:
            tree.add(leaf)
        tree.close()
        return tree

    existing = [whole(low, top, 0) for low, top in layers]
    root = existing[-1].root if layers else leaves[0]

    def paths() -> Iterator[list[bytes]]:
        desired = [Growing(low, top) for low, top in layers]
        for p in range(m):
            path = []
            for k, (low, top) in enumerate(layers):
                if p and not p & ((1 << top) - 1):
                    desired[k].close()
                    existing[k], desired[k] = desired[k], Growing(low, top)
                first = p >> top << top
                for height in range(low, top):
                    beside = (p >> height ^ 1) - (first >> height)
                    row = existing[k].nodes[height - low]
                    path.append(row[beside] if beside < len(row) else b"")
                ahead = p + (1 << top)
                if ahead < m:
                    desired[k].add(leaves[ahead])
            yield path

    return root, paths()


def folded(leaf: bytes, at: int, path: list[bytes]) -> bytes:
    """The root that leaf number `at` and its siblings give."""
    for height, beside in enumerate(path):
        leaf = H(beside, leaf) if beside and at >> height & 1 else H(leaf, beside)
    return leaf


_BLOCK = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("leaf", pa.string()), ("path", pa.binary()), ("steps", pa.list_(pa.string())), ("fold", pa.string()), ("top", pa.string())])


def _blocks(leaves: DataFrame, size: int, upper: bool) -> DataFrame:
    """leaves (grp, pos, n, leaf, seen, ...): a row a leaf with the path within its block as bytes, what `seen` (the leaf as it is
    found now) gives folded up to the block's root, and that root.  upper: the path as `steps`, sibling by sibling with its side."""
    most = height_of(size)
    more = [f for f in leaves.schema.fields if f.name not in ("grp", "pos", "n", "leaf", "seen")]
    schema = "grp string, block long, pos long, n long, leaf string, path binary, steps array<string>, fold string, top string" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)

    def one(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        pos, n = block["pos"].to_pylist(), block["n"][0].as_py()
        found, seen = ([x.encode() for x in block[c].to_pylist()] for c in ("leaf", "seen"))
        root, paths = traverse(found, min(most, height_of(n)))
        joined, steps, folds = [], [], []
        for p, leaf, path in zip(pos, seen, paths, strict=True):
            at = p % size
            joined.append(b"" if upper else bytes.fromhex(b"".join(path).decode()))
            steps.append([("" if not x else "LR"[not at >> k & 1] + x.decode()) for k, x in enumerate(path)] if upper else [])
            folds.append(folded(leaf, at, path).decode())
        out = {"grp": block["grp"], "block": pa.array([p // size for p in pos], pa.int64()), "pos": block["pos"], "n": block["n"], "leaf": block["leaf"], "path": pa.array(joined, pa.binary()),
               "steps": pa.array(steps, pa.list_(pa.string())), "fold": folds, "top": [root.decode()] * len(pos)}
        return pa.table(out | {f.name: block[f.name] for f in more})

    return leaves.withColumn("block", F.floor(F.col("pos") / size)).groupBy("grp", "block").applyInArrow(one, schema)


def _proved(shelf: Shelf, leaves: DataFrame, size: int, upper: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of `_blocks`, and for each (grp, block) the subroot of its group and the steps from the block's root to it."""
    rows = shelf.put(_blocks(leaves, size, upper), "blocks")
    tops = rows.where(F.col("pos") % size == 0).select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("leaf"), F.col("top").alias("seen"))
    if tops.where("n > 1").limit(1).count() == 0:
        return rows, tops.select("grp", F.col("pos").alias("block"), F.col("leaf").alias("subroot"), F.array().cast("array<string>").alias("steps"))
    inner, outer = _proved(shelf, tops, size, True)
    outer = inner.select("grp", "block", "pos", F.col("steps").alias("own")).join(outer, ["grp", "block"])
    return rows, shelf.put(outer.select("grp", F.col("pos").alias("block"), "subroot", F.concat("own", "steps").alias("steps")), "upper")


def _lifted(node: Column, steps: Column) -> Column:
    """A node's digest after the steps: siblings are put to their side, and every step is a digest."""
    return F.aggregate(steps, node, lambda a, s: F.sha2(F.when(s.startswith("L"), F.concat(F.substring(s, 2, 64), a)).when(s.startswith("R"), F.concat(a, F.substring(s, 2, 64))).otherwise(a), 256))


def leaf_of(*columns: Column) -> Column:
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def manifest(spark: SparkSession, leaves: DataFrame, size: int = BLOCK) -> DataFrame:
    """The proofs of rows (grp string or null, ord long, leaf string, seen string): leaf is the digest that the manifest states, seen
    the digest of the row as it is found now.

    Gives grp, ord, leaf, subroot, root, proof_sha256 (digest of the siblings from the leaf to the root), folded_root (from seen and
    the siblings) and verified.  size: leaves of a block, a power of two."""
    if size < 2 or size & (size - 1):
        raise ValueError("a block has a power of two leaves")
    shelf = Shelf(spark, "manifest")
    grp = F.coalesce(F.concat(F.lit("="), F.col("grp")), F.lit(""))
    given = shelf.put(leaves.select(grp.alias("grp"), F.col("ord").cast("long").alias("ord"), "leaf", "seen"), "leaves")
    placed = numbered(shelf, given, "grp", "ord", "leaf")
    rows, tops = _proved(shelf, placed, size)

    subroots = shelf.put(tops.where("block = 0").select(F.lit("all").alias("grp"), F.col("grp").alias("key"), F.col("subroot").alias("leaf")), "subroots")
    over = numbered(shelf, subroots, "grp", "key").withColumn("seen", F.col("leaf"))
    keys, last = _proved(shelf, over, size, True)
    above = keys.select("grp", "block", "key", F.col("steps").alias("own")).join(last, ["grp", "block"])
    above = shelf.put(above.select(F.col("key").alias("grp"), F.col("subroot").alias("root"), F.concat("own", "steps").alias("last")), "above")

    whole = tops.join(above, "grp").select("grp", "block", "subroot", "root", F.concat("steps", "last").alias("up"))
    out = rows.drop("steps").join(whole, ["grp", "block"])
    siblings = F.concat(F.lower(F.hex("path")), F.array_join(F.transform("up", lambda s: F.substring(s, 2, 64)), ""))
    out = out.select(F.expr("CASE WHEN grp = '' THEN NULL ELSE substr(grp, 2) END").alias("grp"), "ord", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), _lifted(F.col("fold"), F.col("up")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def documents_manifest(spark: SparkSession, docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The manifest of documents by lang and doc_id, held against a copy in which n_chars is one more wherever 7 divides the unsigned
    crc32 of the decimal doc_id (null: of nothing)."""
    c = {name: F.col(name) for name in FIELDS}
    changed = F.when(F.crc32(F.coalesce(c["doc_id"].cast("string"), F.lit("")).cast("binary")) % 7 == 0, c["n_chars"] + 1).otherwise(c["n_chars"])
    leaves = docs.select(c["lang"].alias("grp"), c["doc_id"].alias("ord"), leaf_of(*(c[n] for n in FIELDS)).alias("leaf"), leaf_of(*(changed if n == "n_chars" else c[n] for n in FIELDS)).alias("seen"))
    out = manifest(spark, leaves, size)
    return out.select(F.col("ord").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
