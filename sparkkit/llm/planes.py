"""Token ids in files of compressed bit or byte planes.

A file is a run of sections, each ended by a line feed:

* a section for each block of ids: the block's planes, each compressed with zstandard;
* after every so many documents, and at the end, a section with these documents: their ids and lengths as zstandard frames of 64-bit numbers;
* the footer: the chunk index as JSON, its length as ten digits, and the mark ``TKPLANE1``.

All blocks of a file but the last hold the same number of ids. The index gives, for every block,
its place, its number of ids, and the lengths of its compressed planes (0: the plane has no bit
set and is not stored); for every section of documents, its place, its two lengths and its number of documents. Planes above the highest bit in use are left out. Documents lie in
ascending order of their ids, within a file and from file to file.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, texts_of
from sparkkit.llm.tokens import encode_texts

MAGIC = b"TKPLANE1"
BLOCK = 65_536
#: Bytes of text that one file should hold at most. Files are read as single values, and theirs are a fraction of this.
FILE_BYTES = 128 << 20
SECTION = "part binary"


def shuffle_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first; an empty plane is b''."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        planes = ids.view(np.uint8).reshape(-1, 4).T[: (top + 7) // 8]
        return [p.tobytes() if p.any() else b"" for p in planes]
    planes = (np.packbits((ids & np.uint32(1 << bit)) != 0, bitorder="little") for bit in range(top))
    return [p.tobytes() if p.any() else b"" for p in planes]


def join_planes(planes: list[bytes], count: int, kind: str = "bit") -> np.ndarray:
    """The ids whose planes these are."""
    if kind == "byte":
        out = np.zeros((count, 4), np.uint8)
        for k, plane in enumerate(planes):
            if plane:
                out[:, k] = np.frombuffer(plane, np.uint8)
        return out.reshape(-1).view("<u4")
    out = np.zeros(count, np.uint32)
    for bit, plane in enumerate(planes):
        if plane:
            out |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little").astype(np.uint32) << np.uint32(bit)
    return out


class PlaneFile:
    """Turns documents' ids into the sections of one file."""

    def __init__(self, kind: str, block: int, level: int, doc_block: int = BLOCK):
        self.kind, self.block, self.doc_block, self.packer = kind, block, doc_block, zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.held = self.at = self.n_docs = self.n_ids = 0
        self.index: list[list] = []
        self.docs: list[list] = []
        self.doc_ids: list[int] = []
        self.lengths: list[int] = []

    def _section(self, ids: np.ndarray) -> bytes:
        planes = [self.packer.compress(p) if p else b"" for p in shuffle_planes(ids, self.kind)]
        self.index.append([self.at, len(ids), *map(len, planes)])
        body = b"".join(planes)
        self.at += len(body) + 1
        return body

    def _docs(self) -> bytes:
        n = min(self.doc_block, len(self.doc_ids))
        ids, lengths = (self.packer.compress(np.asarray(x[:n], "<i8").tobytes()) for x in (self.doc_ids, self.lengths))
        self.docs.append([self.at, len(ids), len(lengths), n])
        self.at += len(ids) + len(lengths) + 1
        del self.doc_ids[:n], self.lengths[:n]
        return ids + lengths

    def add(self, doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> Iterator[bytes]:
        """Takes documents that follow each other; yields the sections that are full."""
        self.doc_ids += doc_ids
        self.lengths += lengths
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)
        while len(self.doc_ids) >= self.doc_block:
            yield self._docs()
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) - len(ids) % self.block
            for a in range(0, whole, self.block):
                yield self._section(ids[a : a + self.block])
            self.waiting, self.held = [ids[whole:].copy()], len(ids) - whole

    def end(self) -> Iterator[bytes]:
        if self.held:
            yield self._section(np.concatenate(self.waiting))
        if self.doc_ids:
            yield self._docs()
        about = {"kind": self.kind, "block": self.block, "blocks": self.index, "docs": self.docs, "n_docs": self.n_docs, "n_ids": self.n_ids}
        footer = json.dumps(about, separators=(",", ":")).encode()
        yield footer + f"{len(footer):010d}".encode() + MAGIC


def read_index(data: bytes) -> dict:
    """The chunk index of a file's bytes."""
    if data[-9:-1] != MAGIC:
        raise ValueError("not a plane file")
    length = int(data[-19:-9])
    return json.loads(data[-19 - length : -19])


def read_block(data: bytes, index: dict, k: int) -> np.ndarray:
    """The ids of block ``k`` alone."""
    at, count, *lengths = index["blocks"][k]
    planes, unpacker = [], zstandard.ZstdDecompressor()
    for length in lengths:
        planes.append(unpacker.decompress(data[at : at + length]) if length else b"")
        at += length
    return join_planes(planes, count, index["kind"])


def read_docs(data: bytes, index: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The document ids of section ``k`` of documents alone, and their numbers of token ids."""
    at, first, second, _ = index["docs"][k]
    unpacker = zstandard.ZstdDecompressor()
    return (np.frombuffer(unpacker.decompress(data[at : at + first]), "<i8"), np.frombuffer(unpacker.decompress(data[at + first : at + first + second]), "<i8"))


def file_count(docs: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Files for all texts of ``docs`` at about ``file_bytes`` of text each; the session's shuffle partitions at least, so that all cores work."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // file_bytes))


def write_planes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, files: int | None = None, kind: str = "bit", block: int = BLOCK, level: int = 3, doc_block: int = BLOCK) -> None:
    """Encodes all texts, each followed by ``end_id``, and writes them below ``path``.

    Documents are dealt by ranges of doc_id (rows of one id further by a hash of the text), so a file is one task's documents in ascending
    order and the names of the files follow the ranges. A task hands on its sections one by
    one; Spark's own text writer joins them with line feeds and commits the files, so they may
    lie in any store that Spark can write, and a task that is run again leaves one copy.
    ``files`` defaults to ``file_count``: it grows with the bytes of text, so that a file stays small however much there is. A file's documents
    are listed in sections of ``doc_block``, so what a task holds does not grow with its file.

    Null and empty texts have the end id alone, null ids come first, written as -2^63. Repeated rows are
    written each. An empty table gives files without documents, or none.
    """
    files = files or file_count(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        file = PlaneFile(kind, block, level, doc_block)

        def rows(sections):
            for section in sections:
                yield pa.RecordBatch.from_arrays([pa.array([section], pa.binary())], ["part"])

        for batch in slices(batches):
            ids, starts = encode_texts(batch.column("text"), tokenizer)
            lengths = np.diff(starts)
            ended = np.insert(ids, starts[1:], np.int32(end_id))
            doc_ids = [-(2**63) if x is None else x for x in batch.column("doc_id").to_pylist()]
            yield from rows(file.add(doc_ids, (lengths + 1).tolist(), ended))
        yield from rows(file.end())

    ordered = texts_of(docs).repartitionByRange(files, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, SECTION).select(F.col("part").cast("string")).write.text(path)


def read_planes(spark: SparkSession, path: str) -> DataFrame:
    """file_no, doc_id, start (ids of all documents before it) and ids of every document in the files below ``path``.

    ``ids`` is binary: unsigned 32-bit numbers, lowest byte first. A file's number is its place in the order of names. Only the totals of the files, one row
    each, are summed up and sent to all tasks.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([one.column("path"), pa.array([read_index(one.column("content")[0].as_py())["n_ids"]], pa.int64())], ["path", "n_ids"])

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                yield from _documents(name, content.as_py())

    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.mapInArrow(totals, "path string, n_ids bigint").select(
        "path", (F.row_number().over(Window.orderBy("path")) - 1).cast("bigint").alias("file_no"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"),
    )
    found = files.mapInArrow(docs, "path string, doc_id bigint, within bigint, ids binary")
    return found.join(F.broadcast(firsts), "path").select("file_no", "doc_id", (F.col("first") + F.col("within")).alias("start"), "ids")


def _documents(name: pa.Scalar, data: bytes, at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The documents of a file, about ``at_once`` ids (one document at least) at a time; blocks and lists of documents are unpacked as they are needed."""
    index = read_index(data)
    ids, block, given = np.zeros(0, np.uint32), 0, 0
    for k in range(len(index["docs"])):
        doc_ids, lengths = read_docs(data, index, k)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = 0
        while first < len(doc_ids):
            done = max(first + 1, int(np.searchsorted(ends, ends[first] + at_once, "right")) - 1)
            stops = ends[first : done + 1] - ends[first]
            parts, held = [ids], len(ids)
            while held < stops[-1]:
                parts.append(read_block(data, index, block))
                held += len(parts[-1])
                block += 1
            ids = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name.as_py()] * (done - first), pa.string()), pa.array(doc_ids[first:done]), pa.array(given + stops[:-1]),
                    pa.Array.from_buffers(pa.binary(), done - first, [None, pa.py_buffer((stops * 4).astype(np.int32)), pa.py_buffer(ids[: stops[-1]].astype("<u4"))]),
                ],
                ["path", "doc_id", "within", "ids"],
            )
            ids, given, first = ids[stops[-1] :], given + int(stops[-1]), done
