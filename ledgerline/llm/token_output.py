"""Token-id shards in a byte-aligned variable-length code (operator 5).

Ids are ranked by how often the corpus uses them, so the frequent ones have
small numbers. A rank takes one to four bytes; two bits per rank, four to a
control byte, say how many. Control bytes stand apart from the data bytes, so
a reader looks up each control byte in a table of four lengths, sums the
lengths to offsets, and gathers all data bytes with numpy.

A shard file (``.tok``), little-endian: ``MAGIC``; blocks; the blocks' offsets
(u64 each); their number (u64); ``MAGIC``. A block: n_docs, n_ids, n_control,
n_data (u64 each); doc_ids (i64), whether each is null (u8), ids per document
(u64); control bytes; data bytes. ``ranks.u32`` beside the shards lists the
ids by rank.

Scale: texts are tokenised where they are read, once, and kept as ids of two
or four bytes; the ranks need one small aggregate per id; the ids are then
range-partitioned by doc_id, a shard per task. Starts follow from the totals
in the manifest. Nothing but the id counts (at most the vocabulary) and the
sums of a shard reaches the driver.

Tokenising splits a text at spaces that no white space precedes: such a space
always starts a new piece of the byte-level pattern, so the ids of the parts
are the ids of the whole. Each different part goes through the tokenizers
library once per batch, and a bounded number stay cached per worker.

Defined cases: null or empty text has the end id alone; an empty table gives
no shard; null doc_ids come first; rows that repeat an id stand in the order
of their ids' checksums; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import files
from ledgerline.llm.common import pieces, scratch_path, stored

MAGIC = b"LLTOKS1\n"
END_ID = 2
SHARD_IDS = 16_000_000
BLOCK_IDS = 2_000_000
CACHED_PARTS = 400_000
SLICE_BYTES = 8 << 20
#: Words that are one piece: letters that every Unicode version knows as such.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: The byte-level alphabet: printable bytes stand for themselves, the others
#: follow from code point 256 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LEVEL = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _state() -> types.ModuleType:
    """What a Python worker keeps from task to task: tokenizers, cached parts."""
    return sys.modules.setdefault("ledgerline_llm_worker", types.ModuleType("ledgerline_llm_worker"))


class Encoder:
    """Ids of whole texts, by parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.parts: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.marker = "<|endoftext|>" if self.tokenizer.token_to_id("<|endoftext|>") is not None else None

    @staticmethod
    def shared(path: str) -> Encoder:
        kept = _state().__dict__.setdefault("encoders", {})
        if path not in kept:
            kept[path] = Encoder(path)
        return kept[path]

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _fresh(self, parts: list[str]) -> list[bytes]:
        """Ids of texts that begin with a space or stand alone; many go to the
        library in one call, apart by a token that none of them holds."""
        if not parts:
            return []
        if self.marker is None or any("<|" in x for x in parts):
            return self.whole(parts)
        end = self.tokenizer.token_to_id(self.marker)
        out: list[bytes] = []
        groups = [parts[k:k + 512] for k in range(0, len(parts), 512)]
        for own, ids in zip(groups, self.whole([self.marker.join(x) for x in groups]), strict=True):
            row = np.frombuffer(ids, self.dtype)
            cuts = np.flatnonzero(row == end)
            starts = np.concatenate(([0], cuts + 1))
            stops = np.concatenate((cuts, [len(row)]))
            assert len(starts) == len(own)
            out += [row[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        return out

    def _piece(self, word: str) -> bytes:
        """Ids of a word of letters behind a space: one piece of the byte-level
        pattern, so the library's model takes it without the splitting."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LEVEL)
        ids = array(self.dtype.char, [x.id for x in self.model.tokenize("\u0120" + word)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _look_up(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that stand behind a space. Letters and the marks behind
        them are pieces of their own, so a word is encoded once, whatever
        mark follows it."""
        found = list(map(self.parts.get, parts))
        missing = [k for k, x in enumerate(found) if x is None]
        if not missing:
            return found
        known, tails, other = self.parts, self.tails, []
        for k in missing:
            core, tail = parts[k], b""
            word = core.rstrip(".,;:!?")
            if len(word) < len(core) and word.isalpha():
                marks = core[len(word):]
                if marks not in tails:
                    tails[marks] = self.whole([marks])[0]
                core, tail = word, tails[marks]
            ids = known.get(core)
            if ids is None:
                if not PLAIN.fullmatch(core):
                    other.append((k, core, tail))
                    continue
                ids = self._piece(core)
                if len(known) < CACHED_PARTS:
                    known[core] = ids
            found[k] = ids + tail
        for (k, core, tail), ids in zip(other, self._fresh([" " + x for _, x, _ in other]), strict=True):
            found[k] = ids + tail
            if len(known) < CACHED_PARTS:
                known[core] = ids
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: none), as bytes. Works through the
        texts some ``SLICE_BYTES`` at a time, which bounds the memory of a
        batch (one longer text is a slice of its own)."""
        bounds = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(bounds)) + 1).tolist(), len(texts)]
        return [x for a, b in zip(cuts, cuts[1:], strict=False) for x in self._encode(texts.slice(a, b - a))]

    def _encode(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] ").to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        if odd.any():
            rows = np.flatnonzero(odd)
            for i, ids in zip(rows.tolist(), self.whole(texts.take(pa.array(rows)).to_pylist()), strict=True):
                out[i] = ids
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        offsets = split.offsets.to_numpy()
        flat = split.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        firsts = flat.take(pa.array(offsets[:-1])).dictionary_encode()
        known = self._look_up(coded.dictionary.to_pylist())
        number[offsets[:-1]] = len(known) + firsts.indices.to_numpy(zero_copy_only=False)
        known += self._fresh(firsts.dictionary.to_pylist())
        width = self.dtype.itemsize
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // width
        begins = np.concatenate(([0], np.cumsum(sizes, dtype=np.int32)[:-1])).astype(np.int32)
        table = np.frombuffer(b"".join(known), self.dtype)
        upto = np.concatenate(([0], np.cumsum(sizes[number], dtype=np.int32))).astype(np.int32)
        for k in range(0, len(plain), 256):  # bounded memory: some documents at a time
            a, b = offsets[k], offsets[min(k + 256, len(plain))]
            own = number[a:b]
            shift = np.repeat(begins[own] - (upto[a:b] - upto[a]), sizes[own])
            shift += np.arange(len(shift), dtype=np.int32)
            ids = table[shift]
            at = upto[offsets[k:min(k + 256, len(plain)) + 1]] - upto[a]
            for i, x, y in zip(plain[k:k + 256].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                out[i] = ids[x:y].tobytes()
        return out


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks (u32)."""
    n = len(ranks)
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    codes[:n] = extra
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    sizes = extra.astype(np.int64) + 1
    stops = np.cumsum(sizes)
    starts = stops - sizes
    data = np.empty(int(stops[-1]) if n else 0, np.uint8)
    data[starts] = ranks & 0xFF
    for k in (1, 2, 3):
        rows = np.flatnonzero(extra >= k)
        if not len(rows):
            break
        data[starts[rows] + k] = (ranks[rows] >> (8 * k)) & 0xFF
    return control.tobytes(), data.tobytes()


def length_table() -> np.ndarray:
    """Of each control byte, the lengths of its four ranks."""
    byte = np.arange(256, dtype=np.uint8)
    return np.stack([(byte >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1)


def decode_ranks(control: bytes, data: bytes, n: int, table: np.ndarray) -> np.ndarray:
    sizes = table[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    stops = np.cumsum(sizes, dtype=np.int64)
    starts = stops - sizes
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        rows = np.flatnonzero(sizes > k)
        if not len(rows):
            break
        out[rows] |= raw[starts[rows] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def token_ids(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids, sum): each text's ids as little-endian integers of two
    bytes (four for a vocabulary over 65,536), and their CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(path)
        end = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
        for piece in (x for batch in batches for x in pieces(batch, 1, SLICE_BYTES)):
            ids = [x + end for x in encoder.encode(piece.column(1))]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(ids, pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                names=["doc_id", "ids", "sum"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids binary, sum long")


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """(id, n): how often each id occurs in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0)
            for k in range(0, len(column), 512):
                own = np.bincount(np.frombuffer(b"".join(column.slice(k, 512).to_pylist()), dtype))
                if len(own) > len(total):
                    total = np.concatenate((total, np.zeros(len(own) - len(total), np.int64)))
                total[:len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_block(out, rows: list[tuple], ranks: np.ndarray, dtype: str) -> int:
    """Write the documents (doc_id, ids) as one block; its bytes."""
    ids = np.concatenate([np.frombuffer(x, dtype) for _, x in rows])
    control, data = encode_ranks(ranks[ids])
    parts = [struct.pack("<4Q", len(rows), len(ids), len(control), len(data)),
             np.array([0 if i is None else i for i, _ in rows], "<i8").tobytes(),
             np.array([i is None for i, _ in rows], np.uint8).tobytes(),
             np.array([len(x) // np.dtype(dtype).itemsize for _, x in rows], "<u8").tobytes(), control, data]
    for x in parts:
        out.write(x)
    return sum(map(len, parts))


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int | None = END_ID,
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenise ``docs`` and write the shards to ``folder``. Returns the
    manifest: path, n_docs, n_ids and start (ids in earlier shards)."""
    spark = docs.sparkSession
    tokens = stored(token_ids(docs, path, end_id), "ids")
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 65536 else "<u4"
    counts = [tuple(r) for r in id_counts(tokens, dtype).collect()]  # at most the vocabulary
    counts.sort(key=lambda r: (-r[1], r[0]))
    by_rank = np.array([r[0] for r in counts], "<u4")
    ranks = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank))
    with files.create(f"{folder}/ranks.u32") as out:
        out.write(by_rank.tobytes())
    shards = max(1, -(-sum(r[1] for r in counts) // shard_ids))
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = files.new_name(folder, "shard", ".tok")
        out, offsets, at, held, n = None, [], len(MAGIC), [], 0
        n_docs = n_ids = 0
        first = None
        width = np.dtype(dtype).itemsize
        for batch in batches:
            for doc_id, ids, check in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2).to_pylist(), strict=True):
                if out is None:
                    out, first = files.create(uri), (doc_id, check)
                    out.write(MAGIC)
                held.append((doc_id, ids))
                n += len(ids) // width
                n_docs += 1
                n_ids += len(ids) // width
                if n >= BLOCK_IDS:
                    offsets.append(at)
                    at += write_block(out, held, shared.value, dtype)
                    held, n = [], 0
        if out is None:
            return
        if held:
            offsets.append(at)
            write_block(out, held, shared.value, dtype)
        out.write(np.array([*offsets, len(offsets)], "<u8").tobytes() + MAGIC)
        out.close()
        yield pa.RecordBatch.from_pydict({"path": [uri], "n_docs": [n_docs], "n_ids": [n_ids], "first": [first[0]],
                                          "first_sum": [first[1]]}, schema=kind)

    kind = pa.schema([("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first", pa.int64()),
                      ("first_sum", pa.int64())])
    written = stored(tokens.repartitionByRange(shards, "doc_id", "sum").sortWithinPartitions("doc_id", "sum")
                     .mapInArrow(run, "path string, n_docs long, n_ids long, first long, first_sum long"), "manifest")
    before = Window.orderBy(F.col("first").asc_nulls_first(), "first_sum").rowsBetween(Window.unboundedPreceding, -1)
    return written.select("path", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def read_shard(uri: str, by_rank: np.ndarray, table: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, ids per document, all their ids) of each block of a shard."""
    with files.open_read(uri) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        if tail[8:] != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        count = struct.unpack("<Q", tail[:8])[0]
        for at in np.frombuffer(f.read_at(8 * count, size - 16 - 8 * count), "<u8").tolist():
            n_docs, n_ids, n_control, n_data = struct.unpack("<4Q", f.read_at(32, at))
            head = f.read_at(17 * n_docs, at + 32)
            doc_ids = np.frombuffer(head, "<i8", n_docs).tolist()
            nulls = np.frombuffer(head, np.uint8, n_docs, 8 * n_docs).tolist()
            sizes = np.frombuffer(head, "<u8", n_docs, 9 * n_docs).astype(np.int64)
            at += 32 + 17 * n_docs
            ranks = decode_ranks(f.read_at(n_control, at), f.read_at(n_data, at + n_control), n_ids, table)
            yield [None if x else i for i, x in zip(doc_ids, nulls, strict=True)], sizes, by_rank[ranks]


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the shards
    that the manifest lists; a shard per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = table = None
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if table is None:
                    with files.open_read(f"{folder}/ranks.u32") as f:
                        by_rank, table = np.frombuffer(f.read(), "<u4"), length_table()
                for doc_ids, sizes, ids in read_shard(uri, by_rank, table):
                    stops = np.cumsum(sizes)
                    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                    sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((stops - sizes).tolist(), stops.tolist(),
                                                                         strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(start + stops - sizes), pa.array(sizes),
                         pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    start += int(stops[-1])

    rows = manifest.select("path", "start")
    rows = rows.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism))
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, path: str, end_id: int | None = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to the shared folder, read them back: doc_id, start,
    n_tokens, ids_crc32."""
    folder = scratch_path(docs.sparkSession, "tokens")
    manifest = stored(write_shards(docs, folder, path, end_id, shard_ids), "starts")
    return read_shards(manifest, folder)
