"""SentencePiece encoding and decoding that keeps source offsets.

A model file is read once by the driver and sent to the tasks (its size is measured and bounded).  In a task a text is
first normalised by longest prefixes: the model's compiled character map, a double-array trie over UTF-8 bytes, is
walked from each position, the longest entry wins, and every byte that it writes remembers the source byte at which the
entry began.  Blanks become the blank mark in the same pass.  Pieces are then merged by rank (byte-pair encoding), and
the recorded alignment projects each piece's normalised bytes to a span of source bytes.

Merging never joins two characters that no piece of the vocabulary holds side by side, so a text is cut between such
characters and each part is merged for itself; words met before are taken from a bounded table.  A part that is one
very long word is merged with a heap, in O(n log n).
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import batches_of, bytes_column, pick

MAX_MODEL_BYTES = 64 << 20  # a model file is broadcast; larger ones are refused
KNOWN_WORDS = 500_000  # words a task remembers
KNOWN_CHARS = 64  # longer words are merged anew each time

# Fixed values of the model format: kinds of pieces, the model kind handled here, the blank mark, the stand-in for
# bytes that are no UTF-8.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
MARK = "▁"
BROKEN = "�"
NEVER = float("-inf")  # the rank of a pair that is no piece


class CharacterMap:
    """The compiled map: a uint32 size, that many bytes of a double array, then the replacements, each ended by NUL."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]
        self.first = {b for b in range(256) if self._enters(b)}
        self.replaced = functools.lru_cache(1 << 16)(self._replaced)

    def _enters(self, byte: int) -> bool:
        unit = self.units[self._offset(self.units[0]) ^ byte]
        return unit & 0x800000FF == byte

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _replaced(self, at: int) -> bytes:
        return self.strings[at : self.strings.index(b"\0", at)]

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """(end, place of the replacement) of the longest entry that starts at byte ``at``."""
        units, found = self.units, None
        node = self._offset(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                found = end + 1, units[node] & 0x7FFFFFFF
        return found


class Codec:
    """One model: normalise, encode with spans, decode."""

    def __init__(self, serialized: bytes):
        model = sentencepiece_model_pb2.ModelProto.FromString(serialized)
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only byte-pair models without user-defined or unused pieces are read")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that put the blank mark behind words are not read")
        spec = model.normalizer_spec
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.control = {p.piece: k for k, p in enumerate(model.pieces) if p.type == CONTROL}
        self.bos, self.eos = self.control.get(model.trainer_spec.bos_piece), self.control.get(model.trainer_spec.eos_piece)
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == UNKNOWN)
        named = {p.piece: k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = [named.get(f"<0x{b:02X}>") for b in range(256)] if model.trainer_spec.byte_fallback else None
        self.pairs = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        # Words may be cut off before a blank mark where no piece holds one behind another character.
        blanks_lead = all(right != MARK or left == MARK for left, right in self.pairs)
        self.word = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if blanks_lead else r"(?s).+")
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        # By id: normalised bytes (for a byte piece 1), the bytes that decoding writes, and whether a byte piece.
        self.sizes = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        surface = {UNKNOWN: model.trainer_spec.unk_surface, CONTROL: ""}
        self.written = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else surface.get(p.type, p.piece.replace(MARK, " ")).encode() for p in model.pieces]
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        self.leads = [p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces]
        self.invisible = {k for k, p in enumerate(model.pieces) if p.type == CONTROL}

    # ---- normalising ------------------------------------------------------------------------------
    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and for their end the source byte at which it began."""
        if not data:
            return b"", np.zeros(1, np.int64)
        mark = MARK.encode() if self.escape else b" "
        if self.map is None and not self.squeeze:
            # Each source byte is written once, but a blank as the mark's bytes.
            source = np.frombuffer(data, np.uint8)
            origin = np.repeat(np.arange(len(data)), np.where(source == 0x20, len(mark), 1))
            lead = mark if self.prefix else b""
            return lead + data.replace(b" ", mark), np.concatenate((np.zeros(len(lead), np.int64), origin, [len(data)]))
        out, origin = [], []
        after_blank = self.squeeze  # blanks at the start are dropped like repeated ones
        first_kept = None
        for at, end, text in self._prefixes(data):
            if self.squeeze:
                if after_blank:
                    text = text.lstrip(b" ")
                if text:
                    after_blank = text.endswith(b" ")
            if text:
                first_kept = at if first_kept is None else first_kept
                text = text.replace(b" ", mark)
                out.append(text)
                origin.append(np.full(len(text), at))
        if first_kept is None:
            return b"", np.full(1, len(data))
        end = len(data)
        while self.squeeze and out and out[-1].endswith(mark):
            out[-1] = out[-1][: -len(mark)]
            end = int(origin[-1][-1])
            origin[-1] = origin[-1][: len(out[-1])]
            if not out[-1]:
                out.pop()
                origin.pop()
        if self.prefix:
            out.insert(0, mark)
            origin.insert(0, np.full(len(mark), first_kept))
        return b"".join(out), np.concatenate([*origin, [end]]).astype(np.int64)

    def _prefixes(self, data: bytes):
        """(start, end, replacement) of the longest prefixes, one after the other; characters without entry stand for themselves."""
        at = 0
        while at < len(data):
            found = self.map.longest(data, at) if self.map and data[at] in self.map.first else None
            if found:
                yield at, found[0], self.map.replaced(found[1])
                at = found[0]
                continue
            end = at + (1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4)
            yield at, end, data[at:end]
            at = end

    # ---- encoding ---------------------------------------------------------------------------------
    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and start and end of each piece's span in source bytes.

        Where a character is written as bytes, the last of them holds the character and the others are empty.
        """
        normal, origin = self.normalise(data)
        if len(self.known) > KNOWN_WORDS // 2:  # words not met since the last turn are forgotten
            self.known, self.older = {}, self.known
        known = self.known
        parts = self.word.findall(normal.decode("utf-8", "replace"))
        found = [known.get(w) or self._learn(w) for w in parts]
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int32)
        ends = np.cumsum(self._sizes_of(ids, normal))
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        starts, ends = origin[starts], origin[ends]
        is_byte = self.is_byte[ids]
        if is_byte.any():
            starts, ends = self._whole_characters(ids, is_byte, starts, ends)
        return ids, starts, ends

    def _sizes_of(self, ids: np.ndarray, normal: bytes) -> np.ndarray:
        sizes = self.sizes[ids]
        if self.byte_ids is None and (ids == self.unknown).any():
            raise ValueError("spans of unknown characters need a model that writes them as bytes")
        return sizes

    def _whole_characters(self, ids, is_byte, starts, ends):
        """Spans of byte pieces: a character's first byte tells how many there are."""
        starts, ends = starts.copy(), ends.copy()
        for k in np.flatnonzero(is_byte).tolist():
            byte = self.written[ids[k]][0]
            more = 0 if byte < 0xC0 else 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
            if 0x80 <= byte < 0xC0:
                continue
            begin, end = starts[k], ends[k + more]
            starts[k : k + more + 1] = begin
            ends[k : k + more] = begin
            ends[k + more] = end
        return starts, ends

    def _learn(self, word: str) -> tuple[int, ...]:
        if len(word) <= KNOWN_CHARS:
            ids = self.known[word] = self.older.get(word) or tuple(self._merged(word))
            return ids
        pairs, last, ids = self.pairs, 0, []
        for k in range(1, len(word)):
            if (word[k - 1], word[k]) not in pairs:
                ids += self._merged(word[last:k])
                last = k
        return tuple(ids + self._merged(word[last:]))

    def _merged(self, part: str) -> list[int]:
        """Pieces of a part: the best-scored pair of neighbours is merged, the leftmost of equals, until none is a piece."""
        if len(part) > KNOWN_CHARS:
            return self._merged_by_heap(part)
        score, symbols = self.scores.get, list(part)
        ranks = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while ranks and (best := max(ranks)) > NEVER:
            at = ranks.index(best)
            merged = symbols[at] + symbols.pop(at + 1)
            symbols[at] = merged
            del ranks[at]
            if at < len(ranks):
                ranks[at] = score(merged + symbols[at + 1], NEVER)
            if at:
                ranks[at - 1] = score(symbols[at - 1] + merged, NEVER)
        known = self.ids
        return [i for s in symbols for i in ((known[s],) if s in known else self._of(s))]

    def _merged_by_heap(self, part: str) -> list[int]:
        symbols, scores, n = list(part), self.scores, len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-scores[pair], k, k + 1, 2) for k in range(n - 1) if (pair := part[k : k + 2]) in scores]
        heapq.heapify(heap)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = behind = after[right]
            if behind < n:
                before[behind] = left
                if (pair := symbols[left] + symbols[behind]) in scores:
                    heapq.heappush(heap, (-scores[pair], left, behind, len(pair)))
            if (ahead := before[left]) >= 0 and (pair := symbols[ahead] + symbols[left]) in scores:
                heapq.heappush(heap, (-scores[pair], ahead, left, len(pair)))
        return [i for s in symbols if s for i in self._of(s)]

    def _of(self, symbol: str) -> list[int]:
        found = self.ids.get(symbol)
        if found is not None:
            return [found]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in symbol.encode()]

    # ---- decoding ---------------------------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: the leading blank that encoding adds is dropped, bytes that are no UTF-8 are U+FFFD each."""
        written = self.written
        data = b"".join([written[i] for i in ids])
        if self.prefix or self.squeeze:
            data = data[self._added_blanks(ids) :]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._mended(data)

    def _added_blanks(self, ids: list[int]) -> int:
        """Leading blanks to drop: the first piece's; where blanks are squeezed, one of each piece until text begins."""
        dropped = 0
        for i in ids:
            if i in self.invisible:
                continue
            if not self.leads[i]:
                break
            dropped += 1
            if not self.squeeze or len(self.written[i]) > 1:
                break
        return dropped

    @staticmethod
    def _mended(data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            size = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            try:
                out.append(data[at : at + size].decode())
                at += size
            except UnicodeDecodeError:
                out.append(BROKEN)
                at += 1
        return "".join(out)


@functools.lru_cache(2)
def _codec(serialized: bytes) -> Codec:
    return Codec(serialized)


def model_bytes(path: str) -> bytes:
    """A model file's bytes; files over ``MAX_MODEL_BYTES`` are refused, as they are sent to every executor."""
    if os.path.getsize(path) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
_DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", add_bos: bool = False,
           add_eos: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids, starts, ends, of the whole text by the model file ``model``.

    ``starts`` and ``ends`` are each piece's span in bytes of the UTF-8 text, end exclusive; a piece that stands for
    nothing in the source (the added blank, a start or end id) has an empty span.  A null text counts as empty and has
    only the added ids; repeated rows and null ids come back as they are; an empty table gives no rows; other columns
    are not read.
    """
    sent = df.sparkSession.sparkContext.broadcast(model_bytes(model))

    def run(batches):
        codec = _codec(sent.value)
        head = np.array([codec.bos] if add_bos else [], np.int32)
        tail = np.array([codec.eos] if add_eos else [], np.int32)

        def rows():
            for batch in batches:
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), bytes_column(batch, "text")):
                    ids, starts, ends = codec.encode(data)
                    if add_bos or add_eos:
                        ids = np.concatenate((head, ids, tail))
                        starts = np.concatenate((np.zeros(len(head), np.int64), starts, np.full(len(tail), len(data))))
                        ends = np.concatenate((np.zeros(len(head), np.int64), ends, np.full(len(tail), len(data))))
                    yield doc_id, ids, starts, ends

        return batches_of(rows(), _ENCODED, max_rows=1024, weight=lambda r: 20 * len(r[1]))

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, ids array<int>, starts array<bigint>, ends array<bigint>")


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, ids, text decoded from ``ids`` (null counts as none: an empty text)."""
    sent = df.sparkSession.sparkContext.broadcast(model_bytes(model))

    def run(batches):
        codec = _codec(sent.value)

        def rows():
            for batch in batches:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                    values = ids.values.to_numpy() if ids.is_valid else np.empty(0, np.int32)
                    yield doc_id, values, codec.decode(values.tolist())

        return batches_of(rows(), _DECODED, max_rows=1024, weight=lambda r: 8 * len(r[1]))

    return pick(df, doc_id=id_col, ids=ids_col).mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of (doc_id, ids, text)."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
