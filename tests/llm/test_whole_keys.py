"""Keys without digits, short keys, and what only looks like a key."""

import numpy as np
import pytest

from storelens.llm import secret_cnn

CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
NAMES = (
    "Abstract Account Action Adapter Address Agent Alert Alpha Apply Array Async Audio Auth Auto Bar Batch Bean Binary Block "
    "Board Body Book Border Box Bridge Buffer Button Byte Call Camera Card Chain Channel Char Check Child Clock Cloud Code"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def network(docs):
    return secret_cnn.train(docs)


def share(network, values):
    found = secret_cnn.all_spans(network, [f"see {v} for it" for v in values])
    return sum(any(kind == 3 for _, kind, _ in own) for own in found) / len(values)


def test_keys(network):
    rng = np.random.default_rng(31)
    some = lambda chars, n: ["".join(rng.choice(list(chars), n)) for _ in range(300)]
    assert share(network, some(CHARS, 32)) >= 0.9
    assert share(network, some(CHARS + "0123456789", 32)) >= 0.95
    assert share(network, some(CHARS + "0123456789", 16)) >= 0.75


def test_identifiers(network):
    rng = np.random.default_rng(32)
    name = lambda: "".join(rng.choice(NAMES, int(rng.integers(3, 6))))
    shapes = {
        "with a number": [f"{name()}{rng.integers(10, 100)}" for _ in range(300)],
        "without": [f"get{name()}" for _ in range(300)],
        "paths": ["/".join(map(str.lower, rng.choice(NAMES, 5))) + f"/{name()}.java" for _ in range(300)],
        "constants": ["_".join(map(str.upper, rng.choice(NAMES, 4))) for _ in range(300)],
    }
    for shape, values in shapes.items():
        assert share(network, values) < 0.05, shape


def test_clean_documents_of_the_table(docs, network):
    found = secret_cnn.find_secrets(docs, network)
    assert found.where("n_model > 0 and n_assign + n_access + n_hex = 0").count() <= 0.001 * docs.count()


def test_words_are_no_candidates():
    assert secret_cnn.candidates("internationalization -------------------- 12345678901234567890") == []
    assert secret_cnn.candidates("Internationalization") == [(0, 20)]
    assert secret_cnn.candidates("x" * 24) == [(0, 24)] and secret_cnn.candidates("a1" * 8) == [(0, 16)]
