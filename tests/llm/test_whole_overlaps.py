"""Every overlap that the acceptance rule accepts is found: all alignments by hand."""

import random

import numpy as np
import pyarrow as pa

from storelens.llm import spaced_seeds
from storelens.llm.spaced_seeds import needed, overlap
from storelens.llm.textbytes import batch_slices


def hashed(text):
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text])], names=["i", "text"])
    return next(spaced_seeds.word_hashes(o, d)[0] for _, o, d in batch_slices(iter([batch]), "text", ["i"]))


def by_hand(docs, items, least=10, similarity=0.8):
    found, words = set(), {i: hashed(item) for i, item in items}
    for d, document in docs:
        own = hashed(document)
        for i, other in words.items():
            shifts = range(-len(other) + 1, len(own))
            best = max((overlap(own, other, s, similarity) for s in shifts), default=(0, 0, 0))
            if best[0] and best[0] >= needed(len(other), least, similarity):
                found.add((d, i, *best))
    return found


def test_all_accepted_overlaps(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    items = [(n * 10 + k, " ".join(word() for _ in range(n))) for n in [*range(1, 17), 25] for k in range(2)]
    docs = []
    for i, item in items:
        words = item.split()
        for replaced in range(4):
            for _ in range(2):
                own = list(words)
                for at in rng.sample(range(len(own)), min(replaced, len(own) - 1)):
                    own[at] = "zzz"
                low = rng.randint(0, max(0, len(own) - 10))
                own = own[low : rng.randint(low + 8, low + 20)] if rng.random() < 0.4 else own
                around = [word() for _ in range(rng.choice([0, 0, 1, 6]))]
                docs.append((len(docs), " ".join([*around, *own, *around])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in spaced_seeds.contaminated(frame, bench, shortest=1).collect()}
    expected = by_hand(docs, items)
    assert got == expected and len(expected) > 100


def test_masks_follow_from_the_rule():
    """All patterns of equal and replaced words of short items."""
    for n in range(1, 15):
        masks = [[i for i, c in enumerate(m) if c == "1"] + [len(m)] for m in spaced_seeds.masks_of(n, 10, 0.8)]
        for code in range(1 << n):
            equal = np.array([code >> i & 1 for i in range(n)])
            if overlap(equal, np.ones(n, dtype=int), 0, 0.8)[0] < needed(n, 10, 0.8):
                continue
            assert any(equal[[p + i for i in m[:-1]]].all() for m in masks for p in range(n - m[-1] + 1))
