"""Near copies, repeated strings and benchmark passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from storelens.llm import circulant_minhash, frames, spaced_seeds, suffix_arrays, suffix_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def sets_of(text, words):
    found = WORDS.findall((text or "").translate(LOW))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def components_by_hand(rows, words, percent):
    sets = {i: sets_of(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "One", "one", "one two", "ONE  two", "x y z"]
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randint(5, 90))
        for _ in range(14):  # edits around the limit, chains among them
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
        texts += [" ".join(base)] * 5
    return [(i * 3 % 997, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words,block", [(2, 2048), (2, 6), (5, 2048)])
def test_components_against_brute_force(spark, monkeypatch, words, block):
    monkeypatch.setattr(circulant_minhash, "BLOCK_ROWS", block)
    rows = near_copies(random.Random(words))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rep string, n int")
    got = circulant_minhash.near_duplicates(docs.repartition(4), words=words).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components_by_hand(rows, words, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_edges(spark):
    schema = "doc_id long, text string"
    empty = circulant_minhash.near_duplicates(spark.createDataFrame([], schema))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (8, None)]
    got = circulant_minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == Counter(
        [(None, None, False), (7, 7, True), (7, 7, True), (None, None, False), (8, 8, True)]
    )


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 200), (301, 300)]
    got = frames.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    expected = {i: 0 for i in range(31)} | {k: 100 for k in range(100, 140)} | {300: 300, 301: 300}
    assert {r["node"]: r["component"] for r in got} == expected and len(got) == len(expected)


def test_suffix_arrays_are_sorted():
    rng = np.random.default_rng(8)
    for _ in range(300):
        text = np.append(rng.integers(1, rng.integers(2, 5), rng.integers(1, 70)), 0).astype(np.uint16)
        raw = bytes(text.astype(np.uint8))
        array = suffix_arrays.suffix_array(text, 5, 1000)
        assert array.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        wanted = np.zeros(len(text), dtype=bool)
        wanted[: max(len(text) - 12, 0)] = True
        found = suffix_arrays.common_prefixes(text, array, wanted, 12)
        for a, b in zip(array[:-1], array[1:]):
            if wanted[a] and wanted[b]:
                same = next(k for k in range(13) if k == 12 or raw[a + k] != raw[b + k])
                assert found[b] == same


def removed_by_hand(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 2, dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(raw, gone[1:]) if not g)
        chars = sum(b & 0xC0 != 0x80 for b in kept)
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), bool(gone.any()), chars))
    return out


@pytest.mark.parametrize("size", [1 << 22, 300])
def test_repeats_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", size)
    rng = random.Random(9)
    letters = "abé 漢"
    some = lambda n: "".join(rng.choices(letters, k=n))
    shared = [some(60), some(45)]
    texts = [None, "", "short", "a" * 200, "ab" * 90, shared[0], shared[0], "x\0" + shared[1] + "\0\1"]
    for _ in range(40):
        parts = [some(rng.randint(0, 50)), rng.choice(shared), some(rng.randint(0, 30)), rng.choice([*shared, ""])]
        texts.append("".join(parts))
    texts += texts[10:14]
    rows = [(None if i == 12 else i % 45, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=40, pick=8).collect()
    expected = Counter(zip((r[0] for r in rows), removed_by_hand(texts, 40)))
    assert Counter((r[0], tuple(r)[1:]) for r in got) == expected
    nothing = suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert nothing.collect() == []


def test_contamination(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(6)]
    items += [(6, "only four words here"), (7, "seven words make a short test text"), (8, None), (None, "x " * 30), (0, items[0][1])]
    clean = " ".join(word() for _ in range(200))

    def inside(passage):
        return f"{clean[:400]} {passage.upper()} {clean[400:800]}"

    def replaced(text, every):
        return " ".join("zzz" if i % every == every - 1 else w for i, w in enumerate(text.split()))

    docs = [
        (1, inside(items[0][1])), (2, inside(replaced(items[1][1], 7))), (3, clean), (4, None), (5, ""),
        (6, inside("seven words make a short test text")), (7, inside("only four words here")),
        (8, inside(" ".join(items[2][1].split()[:14]))), (9, inside(" ".join(items[3][1].split()[:8]))),
        (10, inside(items[4][1]) + " " + inside(items[4][1])), (10, inside(items[4][1])), (None, items[0][1]),
        (11, items[5][1]), (12, " ".join(reversed(items[5][1].split()))),
    ]
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = spaced_seeds.contaminated(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 0), (2, 1), (6, 7), (8, 2), (10, 4), (11, 5)}
    assert len(got) == 6
    best = {r["doc_id"]: r for r in got}
    assert (best[11]["start_word"], best[11]["end_word"], best[11]["n_equal"]) == (0, 30, 30)
    assert best[8]["n_equal"] == 14
    none = spark.createDataFrame([], "item_id long, text string")
    assert spaced_seeds.contaminated(frame, none).collect() == []
    assert spaced_seeds.contaminated(spark.createDataFrame([], "doc_id long, text string"), bench).collect() == []
