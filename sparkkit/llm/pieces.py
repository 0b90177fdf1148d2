"""SentencePiece encoding and decoding through tables of distinct chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from sparkkit.llm.common import ChunkTable, list_array, lists_to_codes, slices, small_batches, texts_of

MARK = "▁"
_MODELS: dict[str, tuple[sentencepiece.SentencePieceProcessor, ChunkTable | None]] = {}


def chunk_lists(texts: pa.Array) -> pa.ListArray:
    """The chunks of each text: a run of markers and what follows up to the next, less one marker.

    The library puts a marker before a text and writes spaces as markers, so each chunk begins
    with one; encoding a chunk adds the one taken off. The chunk of a single marker with nothing
    after it is the empty string. An empty text has no chunk.
    """
    texts = pc.replace_substring(texts, MARK, " ")
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values
    empty = np.flatnonzero(pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
    odd = np.unique(np.searchsorted(offsets, empty, "right") - 1)
    odd = odd[(odd >= 0) & (odd < len(texts))]
    if not len(odd):
        return lists
    found = [[c[1:] for c in re.findall(" +[^ ]*", " " + text)] if text else [] for text in texts.take(pa.array(odd)).to_pylist()]
    both = pa.concat_arrays([lists, pa.array(found, pa.list_(flat.type))])
    order = np.arange(len(texts))
    order[odd] = len(texts) + np.arange(len(odd))
    return both.take(pa.array(order))


def load(path: str) -> tuple[sentencepiece.SentencePieceProcessor, ChunkTable | None]:
    """The model, and a table of chunks if no piece of it crosses the start of a marker run."""
    if path not in _MODELS:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = model.piece_to_id(MARK)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        spaces = model.encode("a  b ") == [i for c in ("a", " b") for i in model.encode(c)] + [mark]
        probe = " \t ｱﬁ① É  a\x00 "
        whole = crossing or not spaces or model.decode(model.encode(probe)) != probe

        def encode(chunks: list[str]) -> list[list[int]]:
            return [ids if chunk else [mark] for chunk, ids in zip(chunks, model.encode(chunks, num_threads=1))]

        _MODELS[path] = model, None if whole else ChunkTable(encode)
    return _MODELS[path]


def encode(docs: DataFrame, model_file: str, decoded: bool = False) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every whole text, as the library's encode gives them.

    Each block of texts becomes a table of its distinct chunks; chunks that the worker has not
    met are segmented once, and ids are joined back by position. The table stays with the
    Python worker from task to task, so nothing is shuffled. If the model has pieces across
    markers, or normalises texts, whole texts are encoded. ``decoded`` adds ``text``, the
    library's decode of the ids, in the same pass.

    Null and empty texts have no ids. Repeated rows are encoded each, an empty table stays
    empty. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = load(model_file)
        for block in slices(batches):
            if table is None:
                ids = pa.array(model.encode(block.column("text").to_pylist(), num_threads=1), pa.list_(pa.int32()))
            else:
                values, offsets = table.ids(*lists_to_codes(chunk_lists(block.column("text"))))
                ids = list_array(values, offsets, pa.int32())
            texts = {"text": _decoded(ids, model)} if decoded else {}
            columns = {"doc_id": block.column("doc_id"), "ids": ids} | texts
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return texts_of(docs).mapInArrow(run, "doc_id bigint, ids array<int>" + ", text string" * decoded)


def _decoded(ids: pa.ListArray, model: sentencepiece.SentencePieceProcessor) -> pa.Array:
    return pa.array([model.decode(x or []) for x in ids.to_pylist()], pa.string())


def decode(ids: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids and ``text``, the library's decode of each id list (null: empty)."""
    small_batches(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = load(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), _decoded(batch.column("ids"), model)], ["doc_id", "ids", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")
