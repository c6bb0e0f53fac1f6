"""SimHash near-dedup: 64-bit fingerprints of word shingles, compared exactly tile by tile.

A tile holds the distinct fingerprints with the same population counts in each of ``segments`` equal parts of the 64
bits.  Two fingerprints within the radius differ by at most the radius in the sum of those counts' differences, so all
other tile pairs are skipped.  A pair of tiles is compared with numpy: exclusive-or, then bit counts.  Links leave a
task as a spanning forest, never as pairs, so a group of n near copies costs at most n rows in each task.
"""

from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import batches_of, bytes_column, components, pick, small

SEED = 42
BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 3
TILE_ROWS = 4096  # fingerprints of a tile that one task holds against the others
COMPARE_ROWS = 512  # others compared at once: the exclusive-or of TILE_ROWS x COMPARE_ROWS is 16 MB

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a UTF-8 text: bit set where over half the shingle hashes have it; no words: zero."""
    words = text.translate(_LOWER).split()  # bytes.split() cuts at [\x20\x09-\x0D]+
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n)) + np.arange(n)
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: n - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total, counts = n - shingle_words + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, 65536):
        part = [digest(joined[a:b], SEED) for a, b in zip(first[at : at + 65536], last[at : at + 65536])]
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(df: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for each row of ``df`` (doc_id, text); fp is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in bytes_column(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], schema=_FP)

    return df.mapInArrow(run, "doc_id bigint, fp bigint")


def _offsets(segments: int, radius: int) -> list[tuple[int, ...]]:
    """Count differences of tile pairs that are compared; of the two directions of a pair, the one above zero."""
    around = itertools.product(range(-radius, radius + 1), repeat=segments)
    return [d for d in around if sum(map(abs, d)) <= radius and d > (0,) * segments]


def segments_for(n: int, radius: int) -> int:
    """Parts of the 64 bits: the fewest for which the fullest tile of n random fingerprints meets bounded work.

    More parts mean smaller tiles but more copies of each fingerprint.  Any number gives the same links.
    """
    for segments in (2, 4):
        width = BITS // segments
        densest = n * (comb(width, width // 2) / 2**width) ** segments
        if densest * densest * (1 + len(_offsets(segments, radius))) <= 4e10:
            return segments
    return 4


def _tiles(nodes: DataFrame, segments: int, radius: int, tile_rows: int) -> DataFrame:
    """(tile, block, other, fp): each fingerprint at its own tile and, as ``other``, at the tiles it is held against.

    A tile with over ``tile_rows`` fingerprints is cut into blocks; others go to each block of the tile, and the
    tile's own fingerprints also to the blocks after their own.
    """
    width = BITS // segments
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))) for i in range(segments)]
    keyed = nodes.select("fp", F.array(*counts).alias("c"))
    base = width + 2 * radius + 2

    def key(deltas):
        total = F.lit(0).cast("long")
        for i, d in enumerate(deltas):
            total = total * base + (F.col("c")[i] + radius + d).cast("long")
        return total

    keyed = cut_lineage(keyed.select("fp", "c", key((0,) * segments).alias("tile")))
    # At most (width + 1) ** segments rows: the tile table is small whatever the input.
    sizes = keyed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).alias("blocks"))
    sizes = small(cut_lineage(sizes), (width + 1) ** min(segments, 2) * 100)
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    own = keyed.select("fp", "tile").join(sizes, "tile").withColumn("own", block)
    home = own.select("tile", F.col("own").alias("block"), F.lit(0).alias("other"), "fp")
    later = own.where("own + 1 < blocks").select(
        "tile", F.explode(F.expr("sequence(own + 1, blocks - 1)")).alias("block"), F.lit(1).alias("other"), "fp")
    near = keyed.select("fp", F.explode(F.array(*(key(d) for d in _offsets(segments, radius)))).alias("tile"))
    near = near.join(sizes, "tile").select(
        "tile", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(1).alias("other"), "fp")
    return home.union(later).union(near)


class _Forest:
    """Union-find over fingerprints; ``edges`` gives each linked one with its smallest."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def roots(self, xs: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.find, xs.view(np.int64).tolist()), np.int64, len(xs))

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self):
        return ((x, root) for x in list(self.parent) if (root := self.find(x)) != x)


def _compare(radius: int):
    def pairs(home: np.ndarray, others: np.ndarray, forest: _Forest, same: bool) -> None:
        for at in range(0, len(others), COMPARE_ROWS):
            some = others[at : at + COMPARE_ROWS]
            near = np.bitwise_count(some[:, None] ^ home[None, :]) <= radius
            i, j = np.nonzero(near)
            if same:
                i, j = i[i + at < j], j[i + at < j]
            while len(i):
                few = slice(None)
                if len(i) > len(home):  # a dense group: one link a row and round, among those not joined yet
                    apart = forest.roots(some)[i] != forest.roots(home)[j]
                    i, j = i[apart], j[apart]
                    few = np.unique(i, return_index=True)[1]
                for a, b in zip(some[i[few]].view(np.int64).tolist(), home[j[few]].view(np.int64).tolist()):
                    forest.link(a, b)
                if isinstance(few, slice):
                    break

    def run(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        forest, key, parts, home = _Forest(), None, [], None
        for batch in batches:
            tile, block, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "block", "other"))
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(block) != 0) | (np.diff(other) != 0)) + 1
            for a, b in itertools.pairwise([0, *cut.tolist(), len(fp)]):
                if a == b:
                    continue
                here, some = (tile[a], block[a]), fp[a:b]
                if here != key or (not other[a] and home is not None):
                    if home is None and parts:
                        pairs(h := np.concatenate(parts), h, forest, True)
                    key, parts, home = here, [], None
                if not other[a]:
                    parts.append(some.copy())
                    continue
                if home is None:
                    home = np.concatenate(parts) if parts else np.empty(0, np.uint64)
                    pairs(home, home, forest, True)
                if len(home):
                    pairs(home, some, forest, False)
        if home is None and parts:
            pairs(h := np.concatenate(parts), h, forest, True)
        yield from batches_of(forest.edges(), schema)

    return run


def links(nodes: DataFrame, radius: int = MAX_BITS, segments: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) whose components equal those of all pairs of distinct ``fp`` within ``radius`` bits."""
    segments = segments or segments_for(nodes.count(), radius)
    tiles = _tiles(nodes, segments, radius, tile_rows)
    dealt = tiles.repartition("tile", "block").sortWithinPartitions("tile", "block", "other")
    return dealt.mapInArrow(_compare(radius), "u bigint, v bigint")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS, segments: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Two documents are linked when their fingerprints differ in at most ``max_bits`` bits; equal fingerprints are one
    node, so copies are never expanded into pairs.  A null text counts as empty, an empty text has fingerprint zero.
    A null id is in a component like any other but never names it unless all its ids are null.  Repeated rows come
    back once each; an empty table gives no rows.  Other columns are not read.
    """
    prints = cut_lineage(fingerprints(pick(df, doc_id=id_col, text=text_col), shingle_words))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), max_bits, segments, tile_rows))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = cut_lineage(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
