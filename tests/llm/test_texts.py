"""Words, token counts, packing, quality rules: against brute force and the library."""

import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from storelens.llm import bpe_counts, grouped_packing, textbytes, weak_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "'s", "9", "é", "é", "漢", " ", "\x1c", "\x85", "🙂",
          "<|endoftext|>", "<|startoftext|>", "!!", "the", "\r", " ", "_", "ß", "\x00", "Straße", "###", "İ", "Σ"]


def some_text(rng, most=14):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


def test_words_and_hashes():
    rng = random.Random(1)
    texts = [some_text(rng) for _ in range(300)] + [None, "", "x" * 5000, "same words here", "same words here"]
    seen = []
    for row, offsets, data in textbytes.slices(pa.array(texts), limit=64):
        words = textbytes.find_words(offsets, data)
        hashes = textbytes.RangeHash(data)(words.starts, words.ends)
        raw = data.tobytes()
        found = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
        expected = [w for t in texts[row : row + len(offsets) - 1] for w in WORDS.findall(t or "")]
        assert found == expected
        assert np.diff(words.first).tolist() == [len(WORDS.findall(t or "")) for t in texts[row : row + len(offsets) - 1]]
        seen += zip(found, hashes.tolist())
    by_word = {}
    for word, value in seen:
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_token_counts_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, mine = Tokenizer.from_file(path), bpe_counts.Merger(path, remembered=20)
    rng = random.Random(2)
    texts = [some_text(rng) for _ in range(3000)] + ["", "aaaa" * 500, " lead", "trail \n", "a\n", "\nb", "x  y"]
    for text in texts:
        assert mine.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_query_edges(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "word " * 1100, "z"), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == [
        (0, 5500, 1101, True), (1, 0, 0, False), (2, 0, 0, False), (2, 0, 0, False)
    ]


def test_word_ids_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), grouped_packing.WordIds(path)
    rng = random.Random(3)
    texts = [some_text(rng) for _ in range(1500)] + ["", "Don't stop---NOW!!", "x'S y"]
    for text, found in zip(texts, mine.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert found == struct.pack(f"<{len(ids)}I", *ids), repr(text)


@pytest.mark.parametrize("capacity", [16, 100])
def test_plans_are_valid_and_tight(capacity):
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 300, 3000):
        counts = np.bincount(np.clip(rng.lognormal(np.log(capacity / 5), 0.9, n).astype(int), 1, capacity), minlength=capacity + 1)
        plan = grouped_packing.make_plan(counts, capacity, groups=8)
        runs = plan.runs()
        used, placed = {}, np.zeros_like(counts)
        ends = {}
        for length, lo, base, copies, offset in zip(*runs.values()):
            assert lo == ends.get(length, 0)  # ranks of a length are covered without gaps
            many = next((l2 for k, l2 in zip(runs["length"], runs["lo"]) if k == length and l2 > lo), counts[length]) - lo
            ends[length] = lo + many
            placed[length] += many
            for rank in range(many):
                used.setdefault(base + rank // copies, []).append((offset + rank % copies * length, length))
        assert placed.tolist() == counts.tolist()
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
        assert len(used) == plan.sequences <= least * 1.05 + 2


def test_packing_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = [None, "", "x y z " * 900] + [" ".join(rng.choices(["alpha", "beta", "Gamma!", "9"], k=rng.randint(1, 60))) for _ in range(120)]
    rows = [(i % 100 if i < 110 else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(3)
    got = grouped_packing.pack(docs, path, capacity=256).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            expected.append((doc_id, k // 256, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected, key=key)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 256
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 256) + 2


def counts_by_hand(text):
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_rule_counts_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "b", "été", "x*", "\n", "\n", "|", "#", "🙂", "\t", " ", "end."]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "\n\n", "one two three four five " * 3, "x\ny\nx\n"]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    for r in weak_rules.judge_quality(docs).collect():
        own = counts_by_hand(texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == own
        assert r["base_failed"] == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert not (r["base_failed"] and r["kept"])


def test_accuracies_are_estimated():
    """Rules of known accuracy over rows of a known class."""
    rng = np.random.default_rng(7)
    truth = rng.random(6000) < 0.7
    votes = np.full((6000, 5), 2)
    for rule, right in enumerate((0.95, 0.9, 0.85, 0.8, 0.55)):
        says = np.where(rng.random(6000) < right, truth, ~truth)
        votes[:, rule] = np.where(rng.random(6000) < 0.2, 2, says)
    patterns, index, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = weak_rules.estimate(patterns, counts.astype(float))[index.reshape(-1)]
    assert ((posterior >= 0.5) == truth).mean() > 0.93


def test_rules_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = weak_rules.judge_quality(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.join(labels, "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) > 0.97 * len(rows)
