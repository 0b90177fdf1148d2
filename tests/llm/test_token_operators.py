"""SentencePiece, plane files and packing against the libraries themselves."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkkit.llm import packing, pieces, planes
from sparkkit.llm.common import ChunkTable, lists_to_codes
from sparkkit.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


@pytest.mark.parametrize("name", ["odd_docs", "small"])
def test_pieces_equal_the_library(request, model, name):
    docs = request.getfixturevalue(name)
    found = sorted(((r.doc_id, r.ids, r.text) for r in pieces.decode(pieces.encode(docs, PIECES), PIECES).collect()), key=repr)
    expected = []
    for r in docs.collect():
        ids = model.encode(r.text or "")
        expected.append((r.doc_id, ids, model.decode(ids)))
    assert found == sorted(expected, key=repr)
    assert sorted(((r.doc_id, r.ids, r.text) for r in pieces.encode(docs, PIECES, decoded=True).collect()), key=repr) == found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" ▁ab.é\n\t😀ｱ\x00")), max_size=12), max_size=5))
def test_chunks_rebuild_any_text(texts):
    import pyarrow as pa

    model, table = pieces.load(PIECES)
    block = pa.array(texts, pa.string())
    from sparkkit.llm.common import lists_to_codes

    ids, offsets = table.ids(*lists_to_codes(pieces.chunk_lists(block)))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [model.encode(t) for t in texts]


def test_pieces_of_an_empty_table(no_docs):
    assert pieces.decode(pieces.encode(no_docs, PIECES), PIECES).collect() == []


def test_piece_query(spark, model, small):
    found = {r.doc_id: r for r in QUERIES["op1_sentencepiece"](spark, SMALL).collect()}
    for r in small.collect():
        ids = model.encode(r.text or "")
        mine = found.pop(r.doc_id)
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert not found


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("name", ["odd_docs", "small"])
def test_planes_round_trip(request, spark, tokenizer, tmp_path, kind, name):
    docs = request.getfixturevalue(name)
    path = str(tmp_path / "planes")
    planes.write_planes(docs, path, WORDS, end_id=2, files=3, kind=kind, block=1000)
    found = sorted(((r.doc_id, r.start, numbers(r.ids)) for r in planes.read_planes(spark, path).collect()), key=lambda r: r[1])
    expected, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected.append((-(2**63) if r.doc_id is None else r.doc_id, start, ids))
        start += len(ids)
    assert found == expected


def test_planes_of_an_empty_table(spark, no_docs, tmp_path):
    planes.write_planes(no_docs, str(tmp_path / "p"), WORDS, files=2)
    assert planes.read_planes(spark, str(tmp_path / "p")).collect() == []


def test_one_block_of_a_file_can_be_read_alone(spark, small, tmp_path):
    planes.write_planes(small, str(tmp_path / "p"), WORDS, files=1, block=512)
    (file,) = [f for f in (tmp_path / "p").iterdir() if f.name.startswith("part-")]
    data = file.read_bytes()
    index = planes.read_index(data)
    ids = [i for r in planes.read_planes(spark, str(tmp_path / "p")).orderBy("start").collect() for i in numbers(r.ids)]
    assert all(b[1] == 512 for b in index["blocks"][:-1])
    assert planes.read_block(data, index, 3).tolist() == ids[3 * 512 : 4 * 512]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50), st.sampled_from(["bit", "byte"]))
def test_planes_are_reversible(ids, kind):
    values = np.array(ids, np.uint32)
    assert planes.join_planes(planes.shuffle_planes(values, kind), len(ids), kind).tolist() == ids


def test_plane_query(spark, tokenizer, small):
    found = {r.doc_id: r for r in QUERIES["op5_token_planes"](spark, SMALL).collect()}
    start = 0
    for r in small.orderBy("doc_id").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert (found[r.doc_id].start, found[r.doc_id].n_tokens) == (start, len(ids))
        assert found[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def documents_of(windows, size):
    pieces_of = defaultdict(list)
    for w in windows:
        ids = numbers(w.ids)
        assert len(ids) == w.length == sum(p.length for p in w.pieces) <= size
        at = 0
        for p in w.pieces:
            assert p.offset == at and p.length > 0
            pieces_of[p.doc_id].append((p.start, ids[at : at + p.length], p.doc_tokens))
            at += p.length
    return pieces_of


def test_planes_list_documents_in_sections_read_one_by_one(small, tmp_path):
    spark = small.sparkSession
    path = str(tmp_path / "p")
    planes.write_planes(small, path, WORDS, files=1, block=256, doc_block=10)
    data = next((tmp_path / "p").glob("part-*")).read_bytes()
    index = planes.read_index(data)
    listed = [planes.read_docs(data, index, k) for k in range(len(index["docs"]))]
    expected = sorted(r.doc_id for r in small.collect())
    assert np.concatenate([ids for ids, _ in listed]).tolist() == expected and index["n_docs"] == len(expected)
    assert len(listed) == math.ceil(len(expected) / 10)
    assert all(len(ids) == entry[3] for (ids, _), entry in zip(listed, index["docs"])) and sum(n.sum() for _, n in listed) == index["n_ids"]
    for at_once in (1, 700, 1 << 20):
        parts = list(planes._documents(pa.scalar("x"), data, at_once))
        assert [i for p in parts for i in p.column("doc_id").to_pylist()] == expected
        assert all(len(p) == 1 or sum(map(len, p.column("ids").to_pylist())) <= 4 * at_once for p in parts)
        ids = b"".join(b for p in parts for b in p.column("ids").to_pylist())
        assert ids == b"".join(r.ids for r in planes.read_planes(spark, path).orderBy("start").collect())


def test_planes_files_grow_with_the_text_and_one_id_is_dealt_to_several(small, tmp_path):
    spark = small.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = small.agg(F.sum(F.octet_length("text"))).first()[0]
    assert planes.file_count(small) == least and planes.file_count(small.limit(0)) == least
    assert planes.file_count(small, 1000) == max(least, math.ceil(size / 1000))
    same = small.select(F.lit(7).alias("doc_id"), "text")
    planes.write_planes(same, str(tmp_path / "p"), WORDS, files=4)
    found = planes.read_planes(spark, str(tmp_path / "p")).select("file_no", "doc_id", "start", F.octet_length("ids").alias("size")).orderBy("start").collect()
    assert len(found) == small.count() and {r.doc_id for r in found} == {7} and len({r.file_no for r in found}) > 1
    assert [r.start for r in found] == [0, *np.cumsum([r["size"] // 4 for r in found])[:-1].tolist()]


@pytest.mark.parametrize("size", [16, 2048])
def test_packing_loses_no_id(tokenizer, small, size):
    windows = packing.pack(small, WORDS, 1, size).collect()
    assert len({w.sequence_id for w in windows}) == len(windows)
    found = documents_of(windows, size)
    for r in small.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        mine = sorted(found.pop(r.doc_id))
        assert [i for _, part, _ in mine for i in part] == ids
        assert all(total == len(ids) for _, _, total in mine)
        assert [s for s, _, _ in mine] == [sum(len(p) for _, p, _ in mine[:k]) for k in range(len(mine))]
    assert not found
    assert all(w.length == size or w.length & (w.length - 1) == 0 for w in windows)


def test_packing_of_odd_and_no_texts(tokenizer, odd_docs, no_docs):
    windows = packing.pack(odd_docs, WORDS, 1, 64).collect()
    expected = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(w.length for w in windows) == expected
    assert packing.pack(no_docs, WORDS).collect() == []


def test_a_piece_goes_where_the_squares_stay_smallest():
    rng = np.random.default_rng(5)
    packer = packing.SquarePacker(32)
    for k, n in enumerate(rng.integers(1, 32, 400)):
        before = packer.levels.copy()
        costs = []
        for h in range(32 - n + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + n] += h + n < 32
            costs.append((after[1:32] ** 2).sum())
        list(packer.add(k, np.zeros(n, np.int32)))
        assert (packer.levels[1:32] ** 2).sum() == min(costs)


def test_few_open_windows_are_enough(small):
    normal = packing.pack(small, WORDS, 1, 256).collect()
    early = packing.pack(small, WORDS, 1, 256, most_open=4).collect()
    assert sum(w.length for w in normal) == sum(w.length for w in early)


def test_packing_query(spark, tokenizer, small):
    texts = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in small.collect()}
    for r in QUERIES["op10_packing"](spark, SMALL).collect():
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(texts[r.doc_id])


@pytest.mark.parametrize("most", [6, 1000])
def test_chunk_table_drops_the_older_half(most):
    """New chunks only count; whatever is forgotten is encoded again."""
    asked = []
    table = ChunkTable(lambda chunks: asked.extend(chunks) or [[len(c), *c.encode()] for c in chunks], most)
    draw = np.random.default_rng(2)
    for _ in range(30):
        words = [[f"{'c' * x}" for x in draw.integers(0, 12, 4)] for _ in range(3)]
        lists = pa.array(words)
        values, offsets = table.ids(*lists_to_codes(lists))
        assert [values[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [[i for c in ws for i in [len(c), *c.encode()]] for ws in words]
        assert len(table.place) <= max(most, len({c for ws in words for c in ws}))
    assert len(asked) == 12 if most == 1000 else len(asked) > 12
