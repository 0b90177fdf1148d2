"""Word-table encoding with the tokenizers library, for operators that need ids of whole texts."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from sparkkit.llm.common import ChunkTable, split_words

_TABLES: dict[str, ChunkTable] = {}
_MARKS = ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level models write for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Encodes words (no white space inside) exactly as the library encodes them within a text.

    The file's pre-tokenizer drops white space and makes one pre-token of a run of letters, so
    words are independent. A word of plain letters, perhaps with closing marks, goes straight to
    the library's BPE model; everything else through its whole pipeline.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[str, list[int]] = {}
        self.marks: dict[str, list[int]] = {}

    def _plain(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or (unicodedata.is_normalized("NFC", word) and "Σ" not in word and len(word.lower()) == len(word)))

    def _core(self, word: str) -> list[int]:
        word = word.lower()
        if (ids := self.known.get(word)) is None:
            if len(self.known) > 100_000:
                for old in list(self.known)[:50_000]:
                    del self.known[old]
            written = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            ids = self.known[word] = [t.id for t in self.model.tokenize(written)]
        return ids

    def __call__(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        rest = []
        for k, word in enumerate(words):
            core = word.rstrip(_MARKS)
            if not self._plain(core):
                rest.append(k)
                continue
            ids = self._core(core)
            if len(core) < len(word):
                tail = word[len(core) :]
                if tail not in self.marks:
                    if len(self.marks) > 10_000:
                        self.marks.clear()
                    self.marks[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
                ids = ids + self.marks[tail]
            out[k] = ids
        for k, found in zip(rest, self.tokenizer.encode_batch([words[k] for k in rest], add_special_tokens=False)):
            out[k] = found.ids
        return out


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids (int32) of all texts of a block, without special tokens, and where each text begins."""
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(WordEncoder(path))
    return _TABLES[path].ids(*split_words(texts))
