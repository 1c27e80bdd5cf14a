"""Open buckets: links against all pairs, and templates that meet but never link."""

import random
import time

import numpy as np
import pytest

from storelens.llm import circulant_minhash


def sets_near(rng, n, percent):
    """Sets around the limit: edits of few bases, some of one or two shingles."""
    bases = [rng.sample(range(10_000), rng.choice([1, 2, 5, 9, 40, 90])) for _ in range(6)]
    out = []
    for _ in range(n):
        own = set(rng.choice(bases))
        for _ in range(rng.randrange(1 + len(own) * (100 - percent) // 60)):
            own.discard(rng.choice(sorted(own))) if len(own) > 1 and rng.random() < 0.5 else own.add(rng.randrange(10_000))
        out.append(np.array(sorted(own), dtype=np.uint64))
    return out


@pytest.mark.parametrize("percent", [50, 80, 95, 100])
@pytest.mark.parametrize("parts", [1, 2])
def test_links_against_all_pairs(percent, parts):
    rng = random.Random(percent + parts)
    for _ in range(12):
        sets = sets_near(rng, 60, percent)
        comps = np.array([rng.randrange(60) for _ in sets])
        part = np.array([rng.randrange(parts) for _ in sets])
        pairs = set()
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                fits = 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common)
                if fits and comps[i] != comps[j] and (len(set(part)) == 1 or part[i] != part[j]):
                    pairs.add((i, j))
        one, two = circulant_minhash._block_links(sets, comps, part, percent)
        found = {(max(a, b), min(a, b)) for a, b in zip(one.tolist(), two.tolist())}
        assert found <= pairs
        # the links found join the same components
        assert joined(found, comps) == joined(pairs, comps)


def joined(pairs, comps):
    parent = {c: c for c in comps.tolist()}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, j in pairs:
        a, b = sorted((root(int(comps[i])), root(int(comps[j]))))
        parent[b] = a
    return {c: root(c) for c in parent}


def test_templates_do_not_cost_all_pairs():
    rng = np.random.default_rng(5)
    template = rng.integers(1, 1 << 62, 246, dtype=np.uint64)
    sets = [np.unique(np.concatenate([template, rng.integers(1, 1 << 62, 54, dtype=np.uint64)])) for _ in range(4096)]
    start = time.time()
    one, _ = circulant_minhash._block_links(sets, np.arange(4096), np.zeros(4096, int), 80)
    assert len(one) == 0 and time.time() - start < 15


def test_templates_through_the_query(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(50_000)]
    template = rng.choices(vocabulary, k=160)
    rows = []
    for i in range(4000):  # shingle sets of similarity about 0.7
        rows.append((i, " ".join([*template, *rng.choices(vocabulary, k=34)])))
    rows += [(4000 + i, rows[i][1] + " end") for i in range(5)]
    found = circulant_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), words=2)
    linked = {r["doc_id"]: r["component_id"] for r in found.collect() if r["doc_id"] != r["component_id"]}
    assert linked == {4000 + i: i for i in range(5)}


def test_a_component_that_holds_most_of_a_bucket_is_only_looked_up():
    rng = np.random.default_rng(8)
    base = rng.integers(1, 1 << 62, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) > 0.02], rng.integers(1, 1 << 62, 3, dtype=np.uint64)])) for _ in range(4000)]
    sets += [np.unique(np.concatenate([base[:240], rng.integers(1, 1 << 62, 60, dtype=np.uint64)])) for _ in range(50)]
    comps = np.array([0] * 4000 + list(range(1, 51)))
    start = time.time()
    one, _ = circulant_minhash._block_links(sets, comps, np.zeros(len(sets), int), 80)
    assert len(one) == 0 and time.time() - start < 10
