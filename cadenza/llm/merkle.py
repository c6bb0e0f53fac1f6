"""Merkle manifest of a dataset as a persistent tree: a version for each tampered leaf, by path copying.

Leaves stand in id order within their group and are dealt into aligned blocks of 2**BLOCK_BITS positions.  A task that
holds a block folds it into a small tree and keeps every level.  Nothing in a tree is ever overwritten: a tampered leaf
makes a version, which holds new copies of the leaf's ancestors alone and shares every other node with the base tree.
A block's top is a node of the next tree, whose blocks are folded the same way, and so on until a group has one node;
the groups' tops, in group order, make the last tree.  A version that leaves its block goes on through these upper
trees, again by copies of ancestors only.

The sibling digests that a leaf meets on its way to the root are its proof; the upper part of a proof is the same for
all leaves of a block and is joined to them once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.training import global_position
from ..session import cut_lineage
from .common import batches_of, small

BLOCK_BITS = 12
TAMPER_EVERY = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(nodes: bytes) -> bytes:
    return hashlib.sha256(nodes.hex().encode()).digest()


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (hex) over the columns, one after the other: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(s := c.cast("string")).cast("string"), F.lit(":"), s), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


class Tree:
    """The levels of one block, 32-byte digests; never changed once built."""

    def __init__(self, leaves: list[bytes], levels: int | None = None):
        """``levels`` is the height of a block that has others beside it; alone, a block ends at one node."""
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if levels is None else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([digest(b"".join(below[k : k + 2])) for k in range(0, len(below), 2)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, slot: int) -> bytes:
        found = []
        for level in self.levels[:-1]:
            if slot ^ 1 < len(level):
                found.append(level[slot ^ 1])
            slot >>= 1
        return b"".join(found)

    def version(self, slot: int, leaf: bytes) -> list[bytes]:
        """A version with another leaf at ``slot``: its copied nodes, leaf to top; all others are the base tree's."""
        copied = [leaf]
        for level in self.levels[:-1]:
            beside = level[slot ^ 1] if slot ^ 1 < len(level) else b""
            copied.append(digest(beside + copied[-1] if slot & 1 else copied[-1] + beside))
            slot >>= 1
        return copied


def climb(node: bytes, at: int, total: int, siblings: bytes) -> Iterator[bytes]:
    """The ancestors of a node among ``total``, from the siblings on its way."""
    next_ = 0
    while total > 1:
        if at ^ 1 < total:
            beside = siblings[next_ : next_ + 32]
            next_ += 32
            node = digest(beside + node if at & 1 else node + beside)
        else:
            node = digest(node)
        yield node
        at, total = at >> 1, (total + 1) >> 1


_FOLDED = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("pos", pa.int64()), ("total", pa.int64()),
                     ("id", pa.int64()), ("node", pa.binary()), ("changed", pa.binary()), ("siblings", pa.binary()),
                     ("copied", pa.binary()), ("top", pa.binary())])
_FOLDED_DDL = ("grp string, block bigint, blocks bigint, pos bigint, total bigint, id bigint, node binary, changed binary, "
               "siblings binary, copied binary, top binary")


def _blocks(batches, bits: int):
    """(rows, tree) of each block; rows (grp, pos, total, id, node, changed) come sorted by group and position."""
    held, key = [], None

    def tree():
        return held, Tree([r[4] for r in held], bits if held[0][2] > 1 << bits else None)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "pos", "total", "id", "node", "changed"))):
            if held and key != (row[0], row[1] >> bits):
                yield tree()
                held = []
            key = row[0], row[1] >> bits
            held.append(row)
    if held:
        yield tree()


def _fold(bits: int):
    def run(batches):
        def rows():
            for held, tree in _blocks(batches, bits):
                for slot, (grp, pos, total, id_, node, changed) in enumerate(held):
                    copied = b"".join(tree.version(slot, changed)) if changed is not None else None
                    yield (grp, pos >> bits, (total - 1 >> bits) + 1, pos, total, id_, node, changed, tree.siblings(slot), copied, tree.top)

        return batches_of(rows(), _FOLDED)

    return run


def _dealt(nodes: DataFrame, bits: int) -> DataFrame:
    block = F.shiftright("pos", bits)
    return nodes.select("grp", "pos", "total", "id", "node", "changed").repartition("grp", block).sortWithinPartitions("grp", "pos")


def _folded(nodes: DataFrame, bits: int) -> DataFrame:
    """Each node of (grp, pos, total, id, node, changed) beside its siblings, its version's copies and its block's top."""
    return cut_lineage(_dealt(nodes, bits).mapInArrow(_fold(bits), _FOLDED_DDL))


def _tops(folded: DataFrame) -> DataFrame:
    """The blocks' tops as the nodes of the next tree."""
    tops = folded.groupBy("grp", "block").agg(F.first("top").alias("node"), F.first("blocks").alias("total"))
    return tops.select("grp", F.col("block").alias("pos"), "total", F.lit(None).cast("long").alias("id"), "node", F.lit(None).cast("binary").alias("changed"))


def _above(folded: DataFrame, bits: int) -> DataFrame:
    """(grp, block, above, top): for each block of ``folded`` the siblings from its top on, and its group's top."""
    if folded.where("blocks > 1").isEmpty():
        return folded.groupBy("grp", "block").agg(F.first("top").alias("top")).withColumn("above", F.lit(b""))
    upper = _folded(_tops(folded), bits)
    rest = small(_above(upper, bits).select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "above", F.col("top").alias("_top")))
    out = upper.join(rest, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
    return cut_lineage(out.select("grp", F.col("pos").alias("block"), F.concat("siblings", "above").alias("above"), F.col("_top").alias("top")))


def _leaves(df: DataFrame, id_col: str, group_col: str, columns: list[str], changed: Column | None) -> DataFrame:
    """(grp, pos, total, id, node, changed): leaf digests with their places; texts are read once and don't move."""
    picked = df.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{group_col}`").alias("grp"), *([changed.alias("other")] if changed is not None else []))
    cols = [F.col(f"c{k}") for k in range(len(columns))]
    other = F.lit(None).cast("binary")
    if changed is not None:
        swapped = [F.col(f"other.`{c}`") for c in columns]
        other = F.when(F.col("other").isNotNull(), F.unhex(leaf_digest(swapped)))
    rows = cut_lineage(picked.select(F.struct("grp").alias("key"), "id", F.unhex(leaf_digest(cols)).alias("node"), other.alias("changed")))
    placed = global_position(rows, ["id", "node"], ["key"], "pos", "total")
    return placed.select(F.col("key.grp").alias("grp"), "pos", "total", "id", "node", "changed")


_PROVED = pa.schema([("doc_id", pa.int64()), ("grp", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                     ("siblings", pa.list_(pa.string())), ("version", pa.list_(pa.string())), ("folded_root", pa.string())])
_PROVED_DDL = "doc_id bigint, grp string, leaf string, subroot string, root string, siblings array<string>, version array<string>, folded_root string"


def _prove(batches):
    """Each leaf's whole proof; the root recomputed from it, by its version's copies where the leaf was tampered with."""
    def hexes(nodes: bytes) -> list[str]:
        text = nodes.hex()
        return [text[k : k + 64] for k in range(0, len(text), 64)]

    def rows():
        names = ("id", "grp", "node", "copied", "block", "blocks", "pos", "total", "siblings", "above", "subroot", "gpos", "gtotal", "beyond", "root")
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                id_, grp, node, copied, block, blocks, pos, total, siblings, above, subroot, gpos, gtotal, beyond, root = row
                if copied is None:
                    way = [node, *climb(node, pos, total, siblings + above)]
                else:  # the version's copies inside the block, then in the upper trees
                    way = [copied[k : k + 32] for k in range(0, len(copied), 32)]
                    way += climb(way[-1], block, blocks, above)
                way += climb(way[-1], gpos, gtotal, beyond)
                version = [n.hex() for n in way] if copied is not None else None
                yield id_, grp, node.hex(), subroot.hex(), root.hex(), hexes(siblings + above + beyond), version, way[-1].hex()

    return batches_of(rows(), _PROVED)


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
             changed: Column | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per input row: doc_id, grp, leaf, subroot, root, siblings, version, folded_root; digests in hex.

    A leaf is the digest of ``columns``; leaves ascend by id within their group (null first; rows that share an id by
    digest, so rows equal in everything are neighbours).  Groups ascend by UTF-8 bytes, null first.  ``changed`` is a
    struct of the columns as tampered with, null for rows left alone.  ``siblings`` is the proof from leaf to root,
    ``folded_root`` the root recomputed from the tampered leaf, else the original one, and the original siblings, and
    ``version`` the digests of the nodes that a tampered leaf's version copies, leaf to root (null for other rows).
    An empty table gives no rows; other columns are not read.
    """
    folded = _folded(_leaves(df, id_col, group_col, list(columns), changed), block_bits)
    above = cut_lineage(_above(folded, block_bits))
    groups = cut_lineage(above.groupBy("grp").agg(F.first("top").alias("node")))
    # The last tree: the groups' tops in group order, as the leaves of one group.
    placed = cut_lineage(global_position(groups.withColumn("_g", F.struct("grp")), ["_g"], [], "pos").select("grp", "pos", "node"))
    tops = placed.select(F.lit(None).cast("string").alias("grp"), "pos", F.lit(placed.count()).cast("long").alias("total"),
                         F.lit(None).cast("long").alias("id"), "node", F.lit(None).cast("binary").alias("changed"))
    last = _folded(tops, block_bits)
    ways = last.join(small(_above(last, block_bits).select(F.col("block").alias("_b"), "above", F.col("top").alias("root"))), F.col("block") == F.col("_b"))
    ways = ways.select(F.col("pos").alias("gpos"), F.col("total").alias("gtotal"), F.concat("siblings", "above").alias("beyond"), "root")
    ways = placed.withColumnRenamed("pos", "gpos").withColumnRenamed("node", "subroot").join(ways, "gpos")
    ways = small(cut_lineage(ways.withColumnRenamed("grp", "_g")))
    above = small(above.select(F.col("grp").alias("_u"), F.col("block").alias("_b"), "above"))
    rows = folded.join(above, F.col("grp").eqNullSafe(F.col("_u")) & (F.col("block") == F.col("_b"))).drop("_u", "_b")
    rows = rows.join(ways, F.col("grp").eqNullSafe(F.col("_g"))).drop("_g", "top", "changed")
    return rows.mapInArrow(_prove, _PROVED_DDL)


_NODE = pa.schema([("grp", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("node", pa.string())])


def _nodes_of(bits: int, below: int):
    def run(batches):
        def rows():
            for held, tree in _blocks(batches, bits):
                for k, level in enumerate(tree.levels[1:] if below else tree.levels, 1 if below else 0):
                    yield from ((held[0][0], below + k, (held[0][1] >> k) + n, node.hex()) for n, node in enumerate(level))

        return batches_of(rows(), _NODE)

    return run


def nodes(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
          block_bits: int = BLOCK_BITS) -> DataFrame:
    """The base trees' nodes: (grp, level, at, node), level 0 the leaves; what versions share."""
    current, below, found = cut_lineage(_leaves(df, id_col, group_col, list(columns), None)), 0, []
    while True:
        found.append(_dealt(current, block_bits).mapInArrow(_nodes_of(block_bits, below), "grp string, level int, at bigint, node string"))
        if current.where(F.col("total") > 1 << block_bits).isEmpty():
            break
        current = cut_lineage(_tops(_folded(current, block_bits)).where("total > 1"))
        below += block_bits
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def tampered(docs: DataFrame, every: int = TAMPER_EVERY) -> Column:
    """The columns as tampered with: 1 more in n_chars where ``every`` divides the id's unsigned CRC-32, else null."""
    row = F.struct(*((F.col(c) + 1 if c == "n_chars" else F.col(c)).alias(c) for c in COLUMNS))
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, row)


def verified(found: DataFrame) -> DataFrame:
    """proof_sha256 over the siblings, and whether the recomputed root is the manifest's."""
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
