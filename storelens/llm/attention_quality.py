"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is described by
what its words and characters look like, a small layer encodes it, gated
attention weighs the passages against each other, and the weighted representation
is scored. Labels exist for documents only: encoder, gates and scorer are learnt
together from them, in numpy, on a bounded sample of labelled rows. Neither
labels nor language, source or identifier is an input of a score, and the
features are shares, so they do not tell a document's length but for one.

Nulls and empty texts are one empty passage and get a score too. One row comes
out per row, copies and null ids included; extra columns are ignored. Without
labels the model is untrained and says 0.5 for all. A document with several
labels counts as good if most of them say so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as
from storelens.llm.textbytes import RangeHash, batch_slices, find_words, mix

PASSAGE = 64
#: Bound of the labelled sample a model is fitted on.
SAMPLE_DOCUMENTS = 6000
HIDDEN, GATE = 24, 12

_CODES = np.arange(256)
_KINDS = {
    "upper": (_CODES >= 65) & (_CODES <= 90),
    "lower": (_CODES >= 97) & (_CODES <= 122),
    "digit": (_CODES >= 48) & (_CODES <= 57),
    "beyond": _CODES >= 0xC0,
    "symbol": np.isin(_CODES, np.frombuffer(b"#*$%&|<>@^~\\{}[]=+_", np.uint8)),
    "mark": np.isin(_CODES, np.frombuffer(b".,;:!?'\"()-/", np.uint8)),
    "loud": np.isin(_CODES, np.frombuffer(b"!?", np.uint8)),
}
_ENDS = {name: np.isin(_CODES, np.frombuffer(ends, np.uint8)) for name, ends in {
    "stop": b".", "comma": b",;:", "shout": b"!?", "odd": b"#*$%&|<>@^~\\=+_",
}.items()}
FEATURES = len(_KINDS) + len(_ENDS) + 11


def describe(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage, and each row's place of its first passage."""
    words = find_words(offsets, data)
    hashes = RangeHash(data)(words.starts, words.ends)
    n_words = np.diff(words.first)
    parts = np.maximum(-(-n_words // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(parts)])
    within = np.arange(len(hashes)) - words.first[words.row]
    passage = first[words.row] + within // PASSAGE
    total = int(first[-1])
    count = np.bincount(passage, minlength=total)
    size = np.maximum(count, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=values, minlength=total) / size

    length = words.ends - words.starts
    bytes_in = np.maximum(np.bincount(passage, weights=length, minlength=total), 1)
    columns = []
    for kind in _KINDS.values():
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        inside = sums[words.ends] - sums[words.starts]
        columns.append(np.bincount(passage, weights=inside, minlength=total) / bytes_in)
    last = data[words.ends - 1] if len(hashes) else data[:0]
    initial = data[words.starts] if len(hashes) else data[:0]
    columns += [mean(kind[last]) for kind in _ENDS.values()]
    upper = np.concatenate([[0], np.cumsum(_KINDS["upper"][data])])
    capitals = upper[words.ends] - upper[words.starts]
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.argsort(mix(hashes ^ mix(passage.astype(np.uint64))), kind="stable")
    met = np.zeros(len(hashes), dtype=bool)
    met[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (passage[order][1:] == passage[order][:-1])
    earlier = _met_before(hashes, words.row, passage)
    columns += [
        mean(_KINDS["upper"][initial]),
        mean(2 * capitals > length),
        mean(same),
        mean(met),
        mean(earlier),
        mean(length) / 10,
        mean(length**2.0) / 200,
        mean(length <= 2),
        mean(length >= 15),
        count / PASSAGE,
        (count == 0).astype(float),
    ]
    return np.stack(columns, axis=1).astype(np.float32), first


def _met_before(hashes: np.ndarray, row: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """Whether a word and the next occurred in an earlier passage of the row."""
    pair = hashes.copy()
    inside = np.flatnonzero(row[1:] == row[:-1])
    pair[inside] = mix(hashes[inside] ^ (hashes[inside + 1] * np.uint64(3)))
    key = mix(pair ^ mix(row.astype(np.uint64) + np.uint64(77)))
    values, index, inverse = np.unique(key, return_index=True, return_inverse=True)
    return passage[index][inverse] < passage


@dataclass
class Model:
    """Encoder, gated attention and scorer; inputs are standardised."""

    center: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def _forward(self, x: np.ndarray, first: np.ndarray):
        w = self.weights
        z = np.clip((x - self.center) / self.spread, -6, 6)
        h = np.tanh(z @ w["enc"] + w["enc_b"])
        seen, gate = np.tanh(h @ w["att_v"]), 1 / (1 + np.exp(-(h @ w["att_u"])))
        logit = (seen * gate) @ w["att_w"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        top = np.maximum.reduceat(logit, first[:-1])
        e = np.exp(logit - top[bag])
        a = e / np.add.reduceat(e, first[:-1])[bag]
        pooled = np.add.reduceat(a[:, None] * h, first[:-1])
        return z, h, seen, gate, bag, a, pooled, pooled @ w["out"] + w["out_b"][0]

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(first) - 1, 0.5)
        return 1 / (1 + np.exp(-np.clip(self._forward(x, first)[-1], -40, 40)))


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, seed: int = 1) -> Model:
    """Adam on the logarithmic loss, the rarer class weighted up in part."""
    rng = np.random.default_rng(seed)
    flat = np.concatenate(bags)
    model = Model(flat.mean(0), flat.std(0) + 1e-3)
    w = model.weights = {
        "enc": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "enc_b": np.zeros(HIDDEN),
        "att_v": rng.normal(0, 0.3, (HIDDEN, GATE)), "att_u": rng.normal(0, 0.3, (HIDDEN, GATE)),
        "att_w": rng.normal(0, 0.3, GATE), "out": rng.normal(0, 0.3, HIDDEN), "out_b": np.zeros(1),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    share = np.clip(labels.mean(), 0.02, 0.98)
    cost = np.where(labels == 1, (0.5 / share) ** 0.5, (0.5 / (1 - share)) ** 0.5)
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(bags)), max(1, len(bags) // 64)):
            x = np.concatenate([bags[i] for i in batch])
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in batch])])
            z, h, seen, gate, bag, a, pooled, out = model._forward(x, first)
            error = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - labels[batch]) * cost[batch] / len(batch)
            d_pool = np.outer(error, w["out"])
            d_a = (d_pool[bag] * h).sum(1)
            d_logit = a * (d_a - np.add.reduceat(a * d_a, first[:-1])[bag])
            d_both = np.outer(d_logit, w["att_w"])
            d_seen, d_gate = d_both * gate * (1 - seen**2), d_both * seen * gate * (1 - gate)
            d_h = a[:, None] * d_pool[bag] + d_seen @ w["att_v"].T + d_gate @ w["att_u"].T
            d_z = d_h * (1 - h**2)
            grads = {
                "enc": z.T @ d_z, "enc_b": d_z.sum(0), "att_v": h.T @ d_seen, "att_u": h.T @ d_gate,
                "att_w": (seen * gate).T @ d_logit, "out": pooled.T @ error, "out_b": np.array([error.sum()]),
            }
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                g = g + 1e-4 * w[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is for testing only."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for kept, offsets, data in batch_slices(batches, "text", ["label"]):
        x, first = describe(offsets, data)
        rows = [x[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(rows, pa.binary())], names=["label", "bag"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", label_id_col: str = "doc_id") -> Model:
    """Fits on at most SAMPLE_DOCUMENTS labelled documents that are not held out,
    chosen by a hash of their id, half of each class if there are as many; of rows
    with the same id, the one with the smallest text."""
    docs = rows_as(docs, doc_id=id_col, text=text_col).where("doc_id is not null")
    marks = rows_as(labels, doc_id=label_id_col, label=label_col).where("label is not null and doc_id is not null")
    marks = marks.where(~held_out()).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = None
    for label in (0, 1):
        one = marks.where(F.col("label") == label).orderBy(*order).limit(SAMPLE_DOCUMENTS // 2)
        chosen = one if chosen is None else chosen.union(one)
    # at most SAMPLE_DOCUMENTS rows of two numbers, so they can go to every task
    rows = docs.join(F.broadcast(chosen), "doc_id")
    # one row per id, so that a repeated one counts once
    rows = rows.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text"))
    rows = rows.select("label", "text").mapInArrow(_described, "label int, bag binary").collect()
    bags = sorted((r["bag"], r["label"]) for r in rows)
    if not bags:
        return Model(np.zeros(FEATURES), np.ones(FEATURES))
    x = [np.frombuffer(b, "<f4").reshape(-1, FEATURES).astype(float) for b, _ in bags]
    return fit(x, np.array([label for _, label in bags], dtype=float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id"]):
            found = model.score(*describe(offsets, data))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.mapInArrow(run, f"doc_id {ids}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kept, offsets, data in batch_slices(iter([batch]), text_col, batch.schema.names):
                yield kept.filter(pa.array(model.score(*describe(offsets, data)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
