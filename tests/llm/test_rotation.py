"""Fill-in-the-middle texts against slices of token lists, and back again."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import block_rotation as fim

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def by_hand(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, mid, tail = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(head), len(mid), f"<S>{tail}<P>{head}<M>{mid}")
    return (doc_id, n, "psm", len(head), len(mid), f"<P>{head}<S>{tail}<M>{mid}")


def texts(seed):
    rng = random.Random(seed)
    parts = ["a", "Wort", "<P", "<S>", "<", ">", "P>", "M>", "é", "中文", "😀", " ", "\n", "\x00", "12", "xYz", "é", "<M"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(12)))) for i in range(600)]
    return rows + [(None, None), (None, "no number"), (-5, "below zero"), (9000, "word" * 300_000 + "中 " * 200_000)]


def test_against_token_lists_and_back(spark):
    rows = texts(1) + [(3, "copy of three"), (3, "copy of three")]
    df = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, form string, n int")
    out = fim.fill_in_middle(df).cache()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted((by_hand(*r) for r in rows), key=key)
    back = fim.restored(out).collect()
    assert sorted(((r[0], r[1]) for r in back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    digests = fim.fill_in_middle(df, digests=True).collect()
    assert {r["form"] for r in digests} == {"plain", "psm", "spm"}
    of = {}
    for i, t in rows:
        of.setdefault(i, set()).add(hashlib.sha256((t or "").encode()).hexdigest())
    assert all(r["restored_sha256"] in of[r["doc_id"]] for r in digests)
    shas = sorted(hashlib.sha256(r["output"].encode()).hexdigest() for r in out.collect())
    assert shas == sorted(r["output_sha256"] for r in digests)


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_every_cut_is_restored(form):
    for text in (b"", b"x", b"<P", b"M>ab<", "é<S中>".encode()):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                out = fim.transform(text, a, b, form)
                head, mid, tail = text[:a], text[a:b], text[b:]
                whole = b"<P>%s<S>%s<M>%s" % (head, tail, mid) if form == "psm" else b"<S>%s<P>%s<M>%s" % (tail, head, mid)
                assert out == whole and fim.restore(bytes(out), form) == text


def test_rotation():
    for size in range(9):
        for cut in range(size + 1):
            block = np.arange(size + 2, dtype=np.uint8)
            fim.rotate(block, 1, 1 + cut, 1 + size)
            own = list(range(1, size + 1))
            assert block.tolist() == [0, *own[cut:], *own[:cut], size + 1]


def test_other_columns_and_seeds(spark):
    df = spark.createDataFrame([("k1", "some words of a text")], "key string, body string").withColumn("x", F.lit(1))
    first = fim.fill_in_middle(df, "key", "body").collect()[0]
    others = {fim.fill_in_middle(df, "key", "body", seed=str(i)).collect()[0]["output"] for i in range(2, 6)}
    assert first["doc_id"] == "k1" and len(others) > 1
