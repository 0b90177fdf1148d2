"""The pipeline's stages, each against a plain version on what the stage before it kept."""

import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from test_dedup import plain_near
from tokenizers import Tokenizer

import corpus_pipeline
from sparkkit.llm import quality, toxicity
from sparkkit.llm.common import fold
from sparkkit.session import materialize

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What goes into each stage and what the last one returns."""
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    tables = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SMALL), name))
    return tables


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_return_the_columns_of_documents(kept):
    rows = {r.doc_id: tuple(r) for r in kept[0].collect()}
    for df in kept[1:-1]:
        assert df.columns == list(corpus_pipeline.COLUMNS) == kept[0].columns and df.dtypes == kept[0].dtypes
        assert all(rows[r.doc_id] == tuple(r) for r in df.collect())


def test_quality_stage(kept):
    assert ids(kept[1]) == ids(quality.assess(kept[0]).filter("kept"))


def test_toxicity_stage(spark, kept):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter(fold("doc_id") != 0)
    lexicon = toxicity.fit(toxicity.sample_labelled(kept[1], labels))
    bias, by_sum, by_length = lexicon.curve
    stays = []
    for r in kept[1].collect():
        folded = toxicity.fold_text(r.text)
        best = {}
        for entry, weight in lexicon.weights.items():
            for m in re.finditer(f"(?={re.escape(entry)})", folded):
                best[m.start()] = max(best.get(m.start(), 0), weight)
        total = sum(best.values())
        assert not lexicon.exceptions
        z = bias + by_sum * np.log1p(total) + by_length * 100 * total / max(20, len(folded.split()))
        if z < 0:
            stays.append(r.doc_id)
    assert ids(kept[2]) == sorted(stays)


def test_exact_stage(kept):
    first = {}
    for r in kept[2].orderBy("doc_id").collect():
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert ids(kept[3]) == sorted(first.values())


def test_near_stage(kept):
    rows = [(r.doc_id, r.text) for r in kept[3].collect()]
    assert ids(kept[4]) == sorted(i for i, _, c in plain_near(rows, 5) if i == c)


def test_packing_stage(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    parts, windows = defaultdict(list), defaultdict(list)
    for r in kept[5].collect():
        parts[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for r in kept[4].collect():
        at = 0
        for start, length in sorted(parts.pop(r.doc_id)):
            assert start == at
            at += length
        assert at == len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    assert not parts
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)


def test_run_gives_the_rows_of_the_stages(spark, kept):
    found = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.start, r.length) for r in found.collect())[0] is not None
    assert {r.doc_id for r in found.collect()} == set(ids(kept[4]))


def test_run_on_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated rows, ties, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{k} and" for k in range(80)) + "."
    rows = [(1, None, "en", "s", 0), (2, "", None, None, 0), (5, text, "en", "s", 1), (5, text, "en", "s", 1), (4, text + " end", "en", "s", 1), (None, text, "en", "s", 1)]
    for name, given in (("some", rows), ("none", [])):
        spark.createDataFrame(given, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
    found = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert len({r.doc_id for r in found}) == 1
