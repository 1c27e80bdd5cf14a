"""Encoding by distinct chunks against the tokenizer library on whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from storelens.llm import chunk_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\t", "\r", "▁", "a", "the", "<s>", "</s>", "<unk>", "<0x0A>", "é", "é", "中", "😀", "\x00",
        "　", "\xa0", "{", "}", ";", "ing", "==", "//", "﻿", "​", "word,", "Ａ", "ﬁ",
    ]
    out = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]
    for _ in range(n):
        codes = [rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD7FF), rng.randrange(0xE000, 0x10FFFF)]) for _ in range(15)]
        out.append("".join(map(chr, codes)))
    return out + [" " * k for k in range(70)] + ["x" + " " * k + "\n" + " " * k for k in range(40)]


def expected(library, text):
    ids = library.encode(text, num_threads=1)
    return len(ids), ",".join(map(str, ids)), library.decode(ids)


def test_texts_against_the_library(library):
    texts = odd_texts(3, 3000)
    found = chunk_pieces.Encoder(MODEL).encode(texts)
    assert found == [expected(library, t) for t in texts]


def test_each_distinct_chunk_is_segmented_once():
    coder = chunk_pieces.Encoder(MODEL)
    coder.encode(["one two one", "two two\none"])
    # marked and after a line end are different chunks
    assert coder.segmented == 4 and set(coder.table) == {"▁one", "▁two", "\n", "one"}
    coder.encode(["two one"] * 5)
    assert coder.segmented == 4


def test_a_full_table_begins_anew_and_long_chunks_do_not_stay(library):
    coder = chunk_pieces.Encoder(MODEL, limit=3)
    for text in ["a b c d e", "f g h", "a " + "x" * 500, "y" * 500 + " b"]:
        assert coder.encode([text]) == [expected(library, text)]
        assert len(coder.table) <= 9 and all(len(c) <= chunk_pieces.KEPT_CHARS for c in coder.table)


def test_rows(spark, library, monkeypatch):
    texts = [*odd_texts(4, 60), None, "", "same", "same", "long word " * 200_000, "w" * 300_000]
    rows = [(i % 7 if i % 5 else None, t, "en", 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").withColumn("x", F.lit(1))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = [(i, *expected(library, t or "")) for i, t, _, _ in rows]
    key = lambda r: tuple((v is None, v) for v in r)
    found = chunk_pieces.encode_pieces(df, MODEL).collect()
    assert sorted(((r[0], r[1], ",".join(map(str, r[2])), r[3]) for r in found), key=key) == sorted(whole, key=key)
    found = chunk_pieces.encode_pieces(df, MODEL, digests=True).collect()
    assert sorted(map(tuple, found), key=key) == sorted(((i, n, sha(a), sha(b)) for i, n, a, b in whole), key=key)


def test_vocabularies_that_break_the_condition_are_refused(monkeypatch):
    class Crossing(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "of▁the" if i == 500 else super().id_to_piece(i)

    monkeypatch.setattr(chunk_pieces.sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError, match="crosses"):
        chunk_pieces.Encoder(MODEL)
