"""Texts with many secrets: the same spans, in time that follows the text."""

import random
import time

import pytest

from storelens.llm import secret_cnn


def test_ranges_and_the_spans_that_touch_them():
    rng = random.Random(3)
    for _ in range(500):
        cuts = sorted(rng.sample(range(200), 20))
        ranges = list(zip(cuts[::2], cuts[1::2]))
        spans = [(a, a + rng.randrange(1, 60)) for a in (rng.randrange(200) for _ in range(15))]
        for start, end, hits in secret_cnn.overlapping(ranges, spans):
            assert sorted(hits) == sorted((a, b) for a, b in spans if a < end and start < b)
        stretches = secret_cnn.united(spans)
        reach = {x for a, b in spans for x in range(a, b)}
        for start, end in ranges:
            assert secret_cnn.covered(start, end, stretches) == all(x in reach for x in range(start, end))


def test_blanked_windows():
    text = "password = abcDEF0123456789xyz and more text after it " * 3
    for at in range(0, 60):
        for blank in (0, at, max(0, at - 5), at + 3):
            assert (secret_cnn.window(text, at, blank) == secret_cnn.window(" " * blank + text[blank:], at)).all()


def test_time_follows_the_text():
    keys = [f"token={i:08d}abcdefghijklmnop{i % 7}{i % 9}" for i in range(40_000)]

    class Never(secret_cnn.Network):
        def __init__(self):
            self.threshold = 2.0

        def score(self, x):
            return [0.0] * len(x)

    took = []
    for n in (10_000, 40_000):
        start = time.time()
        found = secret_cnn.all_spans(Never(), ["\n".join(keys[:n])])[0]
        took.append(time.time() - start)
        assert sum(k == 0 for _, k, _ in found) == n
    assert took[1] < 10 * took[0] + 1


@pytest.mark.parametrize("n", [2000])
def test_findings_of_one_long_text(spark, n):
    text = " ".join(f"secret: {i:06d}abcdefghij{i % 10}klmnop" for i in range(n))
    df = spark.createDataFrame([(text,)], "text string")
    start = time.time()
    assert df.mapInArrow(secret_cnn._findings, "window binary, label int").count() > n
    assert time.time() - start < 60
