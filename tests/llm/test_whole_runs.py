"""Secrets at the far end of long tokens."""

import numpy as np
import pytest

from storelens.llm import secret_cnn


@pytest.fixture(scope="module")
def network(spark):
    return secret_cnn.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_key_behind_a_path(network):
    rng = np.random.default_rng(8)
    lead = "https://files.example.org/exports/2024/archive/customers/daily/"
    chars = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789")
    keys = ["".join(rng.choice(chars, 30)) for _ in range(100)]
    found = secret_cnn.all_spans(network, [f"see {lead}{key} for it" for key in keys])
    assert sum(any(k == 3 for _, k, _ in own) for own in found) >= 95
    plain = [f"see {lead}report-{n}.html for it" for n in range(100, 200)]
    assert sum(map(bool, secret_cnn.all_spans(network, plain))) <= 5


def test_windows_hold_every_stretch():
    for size in range(20, 400):
        seen = [(p - secret_cnn.BEFORE, p + secret_cnn.LENGTH - secret_cnn.BEFORE) for p in secret_cnn.places(100, 100 + size)]
        assert seen[0][0] <= 100 - secret_cnn.BEFORE and seen[-1][1] >= 100 + size + secret_cnn.AFTER
        for at in range(100, 100 + size - 20):
            stop = min(at + 44, 100 + size)
            assert any(low <= at and stop <= high for low, high in seen)
