"""The secret network's threshold keeps the demanded recall."""

import numpy as np

from storelens.llm import secret_cnn


def test_threshold_is_the_quantile(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert secret_cnn.train(docs).recall >= secret_cnn.RECALL


def test_threshold_may_be_low():
    """Secrets that look like the other class score low and still have to be kept."""
    made, labels = secret_cnn.generated(400, seed=21)
    x = np.stack([secret_cnn.window(text, at) for text, at in made])
    y = np.array(labels, dtype=float)
    rng = np.random.default_rng(1)
    y[(y == 0) & (rng.random(len(y)) < 0.2)] = 1
    net = secret_cnn.fit(x, y, y == 1)
    assert net.recall >= secret_cnn.RECALL and net.threshold < 0.5
