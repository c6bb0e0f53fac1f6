"""Exact dedup by Grace hashing: partition on digest bits until a bucket fits an open-addressing table.

The spill files are Spark's shuffle files: a bucket is a prefix of the content digest, rows are dealt by it, and a
bucket whose distinct content exceeds ``bucket_bytes`` is dealt again on ``step_bits`` more bits, as often as needed.
Before any text moves, each input partition merges its own copies in the same kind of table, so a text that a third
of all rows share crosses the network once for each table filled on the map side.  A hit in a table always compares the complete
content; the digest only says where to look.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import batches_of, pick

# Fixed value: the white-space runs that count as one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"
BUCKET_BYTES = 64 << 20
FILL_BYTES = 8 << 20  # aimed mean size of a bucket
LOCAL_BYTES = 32 << 20  # distinct content that the map side holds before it hands it on
STEP_BITS = 4


class ContentTable:
    """Open addressing with linear probing; entries are told apart by their complete content.

    ``add`` returns the entry number of a content and whether it is new.  ``nbytes`` is the held content.
    """

    def __init__(self, capacity: int = 1024):
        self.slots = [-1] * capacity
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.nbytes = 0

    def add(self, digest: bytes, content: bytes) -> tuple[int, bool]:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (entry := self.slots[at]) >= 0:
            if self.digests[entry] == digest:
                if self.contents[entry] != content:
                    raise ValueError(f"different texts share the digest {digest.hex()}")
                return entry, False
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.nbytes += len(content) + 200
        if len(self.contents) * 3 > len(self.slots) * 2:
            self._grow()
        return entry, True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def normalised(text) -> F.Column:
    """Null counts as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


_RECORD = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("min_id", pa.int64()), ("n", pa.int64())])
_RECORD_DDL = "digest binary, content binary, min_id bigint, n bigint"
_GROUP = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("too_big", pa.int64())])
_GROUP_DDL = "digest binary, keep_id bigint, group_size bigint, too_big bigint"


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _merge_local(limit: int):
    def merge(batches):
        def rows():
            table, ids, counts = ContentTable(), [], []

            def held():
                return zip(table.digests, table.contents, ids, counts)

            for batch in batches:
                for digest, content, doc_id in zip(*(batch.column(c).to_pylist() for c in ("digest", "content", "doc_id"))):
                    entry, new = table.add(digest, content)
                    if new:
                        ids.append(doc_id)
                        counts.append(1)
                    else:
                        ids[entry] = _least(ids[entry], doc_id)
                        counts[entry] += 1
                    if table.nbytes > limit:
                        yield from held()
                        table, ids, counts = ContentTable(), [], []
            yield from held()

        return batches_of(rows(), _RECORD, weight=lambda r: len(r[1]))

    return merge


def _merge_buckets(limit: int):
    """Rows arrive sorted by bucket; one table at a time is held."""
    def merge(batches):
        def rows():
            bucket, table, ids, counts, full = None, None, [], [], False

            def done():
                if full:
                    yield None, None, None, bucket
                elif table is not None:
                    for digest, least, n in zip(table.digests, ids, counts):
                        yield digest, least, n, None

            for batch in batches:
                cols = (batch.column(c).to_pylist() for c in ("bucket", "digest", "content", "min_id", "n"))
                for b, digest, content, least, n in zip(*cols):
                    if table is None or b != bucket:
                        yield from done()
                        bucket, table, ids, counts, full = b, ContentTable(), [], [], False
                    if full:
                        continue
                    entry, new = table.add(digest, content)
                    if new:
                        ids.append(least)
                        counts.append(n)
                        if table.nbytes > limit and len(ids) > 1:
                            table, ids, counts, full = ContentTable(), [], [], True
                    else:
                        ids[entry] = _least(ids[entry], least)
                        counts[entry] += n
            yield from done()

        return batches_of(rows(), _GROUP)

    return merge


def _prefix(digest, bits: int) -> F.Column:
    """The first ``bits`` (at most 60) bits of a digest as a number."""
    head = F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("long")
    return F.shiftright(head, 60 - bits)


def groups_of(docs: DataFrame, total_bytes: int, bucket_bytes: int = BUCKET_BYTES, fill_bytes: int = FILL_BYTES,
              local_bytes: int = LOCAL_BYTES, step_bits: int = STEP_BITS) -> DataFrame:
    """(digest, keep_id, group_size), one row per distinct content of ``docs`` (doc_id, content, digest).

    ``total_bytes``, about all content, sets how finely the first pass deals; later passes follow the buckets found.
    """
    bits = min(40, max(0, math.ceil(math.log2(max(1, total_bytes / fill_bytes)))))
    records = docs.mapInArrow(_merge_local(local_bytes), _RECORD_DDL)
    found, left = [], None
    while True:
        dealt = records.withColumn("bucket", _prefix(F.col("digest"), bits))
        if left is not None:
            dealt = dealt.join(left, _prefix(F.col("digest"), last) == F.col("too_big"), "left_semi")
        # Sixty bits name one digest in practice: such a bucket holds one content and is always taken.
        limit = bucket_bytes if bits < 60 else 1 << 62
        merged = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge_buckets(limit), _GROUP_DDL)
        merged = cut_lineage(merged)
        found.append(merged.where("too_big is null").drop("too_big"))
        left = merged.where("too_big is not null").select("too_big").distinct()
        if left.isEmpty():
            break
        last, bits = bits, min(60, bits + step_bits)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space (a null text is empty).
    Of equal texts the row with the smallest id stays; a null id counts as larger than any other, and of repeated
    rows with that same id exactly one is kept.  An empty table gives no rows.  Other columns are not read.
    ``sizes``: bucket_bytes, fill_bytes, local_bytes, step_bits of the buckets.
    """
    raw = pick(df, doc_id=id_col, text=text_col)
    total = raw.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    text = raw.select("doc_id", normalised(F.col("text")).alias("content"))
    digest = F.unhex(F.sha2(F.col("content"), 256))
    content = F.col("content").cast("binary").alias("content")
    groups = groups_of(text.select("doc_id", content, digest.alias("digest")), total, **sizes)
    again = Window.partitionBy("doc_id", "digest").orderBy("doc_id")
    rows = text.select("doc_id", digest.alias("digest")).withColumn("copy_no", F.row_number().over(again))
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy_no") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
