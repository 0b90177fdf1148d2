import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "\ta b\r\n\x0bc\x0c", "▁x ▁▁ y", "éa É ́", "İstanbul ΣΑΣ ß ſ K",
    "don't we'll <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "１２３ 12 3.5 a1b", "ｱ ﬁ ① \x00 \x1c   z", "😀😀 x😀.", "word, word. WORD!! word?!x ...", "a" * 5000, "la le " * 20000,
]


@pytest.fixture
def odd_docs(spark):
    """Texts with every oddity, repeated rows, a null id, and columns whose names the operators use inside."""
    rows = [(k, t, "en", 1, "x") for k, t in enumerate(ODD_TEXTS)]
    rows += [(5, "a", "en", 1, "x"), (None, "null id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids int, start string").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def small(spark):
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SMALL}/documents.parquet")
