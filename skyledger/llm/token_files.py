"""Binary token files: ids in as few bits as the vocabulary needs, readable at any place.

A file holds consecutive documents::

    magic | blocks | block offsets | document starts | document ids | null flags | footer | magic

Each block packs ``BLOCK`` ids of ``width`` bits (the last block fewer), least significant bit first,
and begins on a byte. Offsets and starts are 64-bit little-endian; the footer has
the width, the ids per block, and the numbers of ids, blocks and documents. To read ids ``a`` to ``b``, read the blocks that
hold them and unpack with numpy.

A task writes its file under a name of its own and returns a manifest row. Only files in the
manifest, which Spark commits, are ever read, so a repeated or lost task does no harm.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map
from skyledger.llm.tokens import TEXT_AT_ONCE, Encoder, small_batches, tokenizer_path
from skyledger.session import scratch_folder, write_and_reread

MAGIC = b"SKYTOK1\n"
FOOTER = struct.Struct("<IIQQQ")
BLOCK = 65536
MANIFEST = "part int, path string, n_ids long, n_docs long"


def _overlaps(width: int) -> Iterator[tuple[int, int, int]]:
    """Eight ids fill ``width`` bytes: each byte and id that share bits, and how far the id is shifted right to meet the byte."""
    for byte in range(width):
        for i in range(8 * byte // width, (8 * byte + 7) // width + 1):
            yield byte, i, 8 * byte - i * width


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits of each id, one after the other."""
    groups = np.zeros((-(-len(ids) // 8), 8), dtype=np.uint64)
    groups.ravel()[: len(ids)] = ids.astype(np.uint64) & np.uint64((1 << width) - 1)
    packed = np.zeros((len(groups), width), dtype=np.uint8)
    for byte, i, shift in _overlaps(width):
        packed[:, byte] |= (groups[:, i] >> np.uint64(shift) if shift >= 0 else groups[:, i] << np.uint64(-shift)).astype(np.uint8)
    return packed.tobytes()[: (len(ids) * width + 7) // 8]


def unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    """The first ``count`` ids of ``width`` bits in ``data``."""
    packed = np.zeros((-(-count // 8), width), dtype=np.uint8)
    held = np.frombuffer(data, dtype=np.uint8)[: packed.size]
    packed.ravel()[: len(held)] = held
    ids = np.zeros((len(packed), 8), dtype=np.uint64)
    for byte, i, shift in _overlaps(width):
        bits = packed[:, byte].astype(np.uint64)
        ids[:, i] |= bits << np.uint64(shift) if shift >= 0 else bits >> np.uint64(-shift)
    return (ids.ravel()[:count] & np.uint64((1 << width) - 1)).astype("<u4")


def _file_system(path: str):
    from pyarrow import fs

    path = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", path))


class TokenFileWriter:
    """Writes documents in order; holds no more than a block of ids and the documents' starts."""

    def __init__(self, path: str, width: int) -> None:
        system, name = _file_system(path)
        if system.type_name == "local":
            system.create_dir(name.rpartition("/")[0])
        self.out, self.width = system.open_output_stream(name), width
        self.out.write(MAGIC)
        self.at, self.offsets, self.starts, self.doc_ids, self.nulls = len(MAGIC), [], [], [], []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append(self.n_ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            whole = np.concatenate(self.held)
            stop = len(whole) - len(whole) % BLOCK
            for i in range(0, stop, BLOCK):
                self._block(whole[i : i + BLOCK])
            self.held, self.n_held = [whole[stop:]], len(whole) - stop

    def _block(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.width)
        self.offsets.append(self.at)
        self.at += len(data)
        self.out.write(data)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(FOOTER.pack(self.width, BLOCK, self.n_ids, len(self.offsets), len(self.starts)) + MAGIC)
        self.out.close()


class TokenFile:
    """Random access to a token file."""

    def __init__(self, path: str) -> None:
        system, name = _file_system(path)
        self.file = system.open_input_file(name)
        end = self.file.size() - FOOTER.size - len(MAGIC)
        tail = self._at(end, FOOTER.size + len(MAGIC))
        if tail[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.width, self.block, self.n_ids, n_blocks, self.n_docs = FOOTER.unpack(tail[: FOOTER.size])
        index = end - 8 * n_blocks - 17 * self.n_docs
        data = self._at(index, end - index)
        self.offsets = np.append(np.frombuffer(data, "<u8", n_blocks), np.uint64(index)).astype(np.int64)
        at = 8 * n_blocks
        self.starts = np.append(np.frombuffer(data, "<u8", self.n_docs, at), np.uint64(self.n_ids)).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at + 8 * self.n_docs)
        self.nulls = np.frombuffer(data, "u1", self.n_docs, at + 16 * self.n_docs).astype(bool)

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``; reads the blocks that hold them."""
        if stop <= start:
            return np.empty(0, dtype="<u4")
        first, last = start // self.block, (stop - 1) // self.block
        data = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        blocks = []
        for b in range(first, last + 1):
            count = min(self.block, self.n_ids - b * self.block)
            lo = int(self.offsets[b] - self.offsets[first])
            blocks.append(unpack_bits(data[lo : lo + (count * self.width + 7) // 8], count, self.width))
        return np.concatenate(blocks)[start - first * self.block : stop - first * self.block]

    def documents(self, ids_at_once: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """Each document's number and ids, in order."""
        d = 0
        while d < self.n_docs:
            stop = max(d + 1, int(np.searchsorted(self.starts, self.starts[d] + ids_at_once, side="right")) - 1)
            ids, base = self.read(int(self.starts[d]), int(self.starts[stop])), self.starts[d]
            for i in range(d, stop):
                yield i, ids[self.starts[i] - base : self.starts[i + 1] - base]
            d = stop


def vocabulary_bits(tokenizer: str, *more: int) -> int:
    """Bits that hold every id of the tokenizer and ``more``."""
    size = Encoder.of(tokenizer).model.get_vocab_size(with_added_tokens=True)
    return max(1, max(size - 1, *more).bit_length())


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write them in ascending ``doc_id`` order; returns the manifest.

    Rows of equal ``doc_id`` follow each other by text; a null id comes first, a null text is
    empty. Every document ends with ``end_id``. The order is made before encoding, since texts
    take less shuffle than ids; very many rows of one id, or of none, are dealt out by how their texts begin. The files hold 64-bit
    ids: a ``doc_id`` that is no whole number ends the job. An empty table writes no file.
    """
    width = vocabulary_bits(tokenizer, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, end, path, out = Encoder.of(tokenizer), end_id.to_bytes(4, "little"), "", None
        for batch in small_batches(batches, "text", TEXT_AT_ONCE):
            if out is None:
                path = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}.bin"
                out = TokenFileWriter(path, width)
            for doc_id, data in zip(batch["doc_id"].to_pylist(), encode(batch["text"]), strict=True):
                out.add(doc_id, np.frombuffer(data + end, dtype="<u4"))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "path": [path],
                    "n_ids": pa.array([out.n_ids], pa.int64()),
                    "n_docs": pa.array([len(out.starts)], pa.int64()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", F.substring("text", 1, 16))
    return write_and_reread(arrow_map(rows.sortWithinPartitions("doc_id", "text"), write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                file = TokenFile(path)
                crc = [zlib.crc32(ids.tobytes()) for _, ids in file.documents()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(file.doc_ids, pa.int64(), mask=file.nulls),
                        "start": pa.array(file.starts[:-1] + base, pa.int64()),
                        "n_tokens": pa.array(np.diff(file.starts), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = manifest.select("part", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base"))
    files = max(1, manifest.count())
    spread = based.repartition(files, "part")
    return arrow_map(spread, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to the shared folder and read every document back."""
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    return read_token_files(write_token_files(docs, scratch_folder(spark, "token-files"), tokenizer, end_id))
