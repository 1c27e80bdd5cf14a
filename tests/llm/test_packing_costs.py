"""Packing: what its words cost, and that cheaper words have the library's identifiers."""

import random
import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from storelens.llm import grouped_packing

SIGNS = ["a", "Z", "Q", "é", "É", "Ö", "ß", "ÿ", "þ", "×", "÷", "Æ", "ª", "µ", "º", " ", "İ", "Σ", "K", "é", "́",
         "漢", "🙂", "'", "'s", "'LL", "!", "?.", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "7", "½", " ", " ", "  ",
         "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\x00", "\x7f", " "]


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


def test_signs_of_all_kinds_equal_the_library(vocabulary, monkeypatch):
    monkeypatch.setattr(grouped_packing, "SLICE_BYTES", 2000)
    monkeypatch.setattr(grouped_packing, "REMEMBERED", 150)
    library, mine = Tokenizer.from_file(vocabulary), grouped_packing.WordIds(vocabulary)
    rng = random.Random(11)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 12))) for _ in range(6000)]
    texts += ["", " ", "\n", "", "a", " a", "a ", "dogs' don't", "Straße.", "÷é", "é÷", "É×", "a.b", "a..", "..a", "A" * 3000]
    found = list(mine.encode(texts))
    assert len(found) == len(texts)
    for text, own in zip(texts, found):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_batches_of_any_cut_give_the_same_pieces(vocabulary):
    library = Tokenizer.from_file(vocabulary)
    texts = [None, "", "x y " * 8, "x " * 15, "x " * 16, "x " * 17, "Word, word. " * 40, "", None]
    expected = []
    for row, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 16):
            part = ids[k : k + 16]
            expected.append((row, k // 16, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"]
    )
    for rows in (1, 2, 4, 100):
        cut = [whole.slice(at, rows) for at in range(0, len(texts), rows)]
        out = list(grouped_packing._pieces(vocabulary, 16)(iter([whole.slice(0, 0), *cut])))
        assert [tuple(r.values()) for batch in out for r in batch.to_pylist()] == expected
    assert list(grouped_packing._pieces(vocabulary, 16)(iter([]))) == []


def test_the_library_meets_each_part_of_words_once(vocabulary):
    """Capitals, punctuation and the batch a word comes in make no further calls."""
    mine, seen = grouped_packing.WordIds(vocabulary), []

    class Counted:
        def __init__(self, library):
            self.library = library

        def encode_batch_fast(self, texts, **options):
            seen.extend(word for text in texts for word in text.split())
            return self.library.encode_batch_fast(texts, **options)

    mine.library, mine.merges = Counted(mine.library), Counted(mine.merges)
    texts = ["Green green, GREEN! green", "tree. Tree tree", "green tree!"] * 50
    for _ in range(3):
        list(mine.encode(texts))
    assert sorted(word for word in seen if word.isalpha()) == ["green", "tree"]
    assert set(seen) == {"!", ",", ".", "green", "tree"} and len(seen) <= 8


def test_batches_are_put_together_before_words_are_looked_up(vocabulary, monkeypatch):
    """A word of many small batches is looked up once per slice, not once per batch."""
    calls = []
    lookup = grouped_packing.WordIds._ids_of
    monkeypatch.setattr(
        grouped_packing.WordIds, "_ids_of", lambda self, words: (calls.append(len(words)), lookup(self, words))[1]
    )
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2], pa.int64()), pa.array(["one two ", "two one "])], names=["doc_id", "text"]
    )
    out = list(grouped_packing._pieces(vocabulary, 16)(iter([batch] * 30)))
    assert sum(b.num_rows for b in out) == 60
    assert calls == [2]
