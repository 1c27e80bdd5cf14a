"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over neighbouring words; the position it leaves out may
differ between a document and a benchmark text. The masks follow from the rule by
which an overlap is accepted, so that every overlap it accepts holds a seed: an
overlap ends where its gain is largest, hence with as many equal words at least as
a replaced word costs, and its last two runs of equal words together have as many
as two replaced words cost. Either the last run alone is that long, or a mask skips
the replaced word before it. Seeds of both sides meet in an equi join;
a filter of fixed size made of the benchmark's seeds keeps nearly all others of a
document from being shuffled. Each hit fixes how the two texts lie against each
other, and the overlap around it is compared word by word: replaced words are
tolerated, up to a share.

A benchmark text of which fewer equal words are enough is searched by runs of so
many, one of up to four words (at the usual values) by all its words; texts below
``shortest`` words are not searched for, the queries search for all. Nulls and
empty texts have no seeds.
Documents and items without an id take no part. The same document or item twice
gives the same findings once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as, stage
from storelens.llm.textbytes import LOWER, RangeHash, batch_slices, find_words, mix

#: Bits of the filter: its size does not depend on the benchmark's.
FILTER_BITS = 24
PROBES = 3
#: An overlap counts from so many equal words (or the whole text if shorter) on.
OVERLAP_WORDS = 10
SIMILARITY = 0.8
#: Shorter benchmark texts are left out unless asked for.
LEAST_WORDS = 5


def needed(words: int, least: int, similarity: float) -> int:
    """How many equal words make an overlap with a text of so many words count."""
    return int(min(least, np.ceil(similarity * words)))


def masks_of(words: int, least: int, similarity: float) -> list[str]:
    """Which neighbouring words the seeds of a text of so many words look at: every
    overlap of it that counts has one of these masks with equal words only."""
    cost = similarity / (1 - similarity) - 1e-9
    last, both = int(cost) + 1, int(2 * cost) + 1  # words of the last run, of the last two
    enough = max(needed(words, least, similarity), 1)
    masks = ["1" * min(both, enough)]
    if words > both:
        masks += ["1" * (both - n) + "0" + "1" * n for n in range(last, both)]
    return masks


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and each row's place of its first word."""
    data = LOWER[data]
    words = find_words(offsets, data)
    return RangeHash(data)(words.starts, words.ends), words.first


def _seeded(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed hash of every window; windows may cross rows."""
    n = max(len(hashes) - len(mask) + 1, 0)
    out = np.full(n, int(mask, 2) + (len(mask) << 32), dtype=np.uint64)
    for i, used in enumerate(mask):
        if used == "1":
            out = mix(out ^ hashes[i : i + n])
    return out


def _windows(first: np.ndarray, size: int) -> np.ndarray:
    """The windows of all rows that stay inside their row."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())


def _item_seeds(least: int, similarity: float, shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["item_id"]):
            hashes, first = word_hashes(offsets, data)
            sizes = np.diff(first)
            users: dict[str, list[int]] = {}  # the sizes of texts that use a mask
            for size in np.unique(sizes[sizes >= max(shortest, 1)]).tolist():
                for mask in masks_of(size, least, similarity):
                    users.setdefault(mask, []).append(size)
            for mask, own in users.items():
                at = _windows(first, len(mask))
                rows = np.searchsorted(first, at, "right") - 1
                used = np.isin(sizes[rows], own)
                at, rows = at[used], rows[used]
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column(0).take(pa.array(rows)),
                        pa.array(at - first[rows]),
                        pa.array(_seeded(hashes, mask)[at].view(np.int64)),
                        pa.array([mask] * len(at), pa.string()),
                    ],
                    names=["item_id", "q", "seed", "mask"],
                )

    return run


def _probe(seeds: np.ndarray, turn: int) -> np.ndarray:
    return (mix(seeds ^ np.uint64(turn + 1)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _probe_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seeds = batch.column(0).to_numpy().view(np.uint64)
        bits = np.concatenate([_probe(seeds, turn) for turn in range(PROBES)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(bits >> 5), pa.array(np.int64(1) << (bits & 31))], names=["place", "bit"]
        )


def _scan(filter_words: np.ndarray, masks: list[str], least: int, similarity: float):
    # masks that only texts use which they cover: any place of such a text is as
    # good as its last one, so that a common word is one hit of a document
    whole = {m for m in masks if needed(len(m) + 1, least, similarity) > len(m) and needed(len(m), least, similarity) == len(m)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(filter_words.view(np.uint8), bitorder="little").view(bool)
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id", "text"]):
            hashes, first = word_hashes(offsets, data)
            places, seeds = [], []
            for mask in masks:
                at = _windows(first, len(mask))
                own = _seeded(hashes, mask)[at]
                for turn in range(PROBES):
                    inside = bits[_probe(own, turn)]
                    at, own = at[inside], own[inside]
                if mask in whole:
                    key = np.stack([np.searchsorted(first, at, "right"), own.view(np.int64)])[:, ::-1]
                    at, own = (v[::-1][np.unique(key, axis=1, return_index=True)[1]] for v in (at, own))
                places.append(at)
                seeds.append(own)
            places = np.concatenate([*places, np.zeros(0, np.int64)])
            seeds = np.concatenate([*seeds, np.zeros(0, np.uint64)])
            row = np.searchsorted(first, places, "right") - 1
            order = np.argsort(row, kind="stable")
            hit, counts = np.unique(row, return_counts=True)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            found = kept.take(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [
                    found.column(0),
                    found.column(1),
                    pa.ListArray.from_arrays(ends, pa.array((places - first[row])[order])),
                    pa.ListArray.from_arrays(ends, pa.array(seeds[order].view(np.int64))),
                ],
                names=["doc_id", "text", "p", "seed"],
            )

    return run


def overlap(document: np.ndarray, item: np.ndarray, shift: int, similarity: float) -> tuple[int, int, int]:
    """(equal words, start, end in the document) of the best overlap when word q of
    the item lies on word q + shift of the document. A differing word costs as
    much as keeps the share of equal words at the similarity."""
    begin, end = max(0, -shift), min(len(item), len(document) - shift)
    equal = item[begin:end] == document[begin + shift : end + shift]
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1.0, -similarity / (1 - similarity)))])
    gains = sums - np.minimum.accumulate(sums)
    stop = int(gains.argmax())
    if stop == 0:
        return 0, 0, 0
    start = int(sums[: stop + 1].argmin())
    return int(equal[start:stop].sum()), begin + shift + start, begin + shift + stop


def _verify(least: int, similarity: float):
    def hashes_of(column: pa.Array) -> list[np.ndarray]:
        out = []
        one = pa.RecordBatch.from_arrays([pa.array(range(len(column))), column], names=["i", "text"])
        for _, offsets, data in batch_slices(iter([one]), "text", ["i"]):
            hashes, first = word_hashes(offsets, data)
            out.extend(hashes[a:b] for a, b in zip(first[:-1], first[1:]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            documents, items = hashes_of(batch.column(2)), hashes_of(batch.column(3))
            for row, shifts in enumerate(batch.column(4).to_pylist()):
                document, item = documents[row], items[row]
                best = max(overlap(document, item, s, similarity) for s in shifts)
                if best[0] >= needed(len(item), least, similarity):
                    rows.append(row)
                    found.append(best)
            kept = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *columns], names=["doc_id", "item_id", "n_equal", "start_word", "end_word"]
            )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: int = OVERLAP_WORDS,
    similarity: float = SIMILARITY,
    shortest: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, item_id, n_equal, start_word, end_word) of every document that
    overlaps a benchmark text, with the largest overlap."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col).where("doc_id is not null and text is not null")
    items = rows_as(benchmark, item_id=item_col, text=item_text_col)
    items = items.where("item_id is not null and text is not null").distinct()
    ids, item_ids = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    seeds = items.mapInArrow(_item_seeds(least, similarity, shortest), f"item_id {item_ids}, q long, seed long, mask string")
    seeds = stage(seeds, "seeds-benchmark")
    # at most 2^FILTER_BITS / 32 rows and a few masks, whatever the benchmark's size
    words = seeds.select("seed").mapInArrow(_probe_words, "place long, bit long")
    words = words.groupBy("place").agg(F.bit_or("bit").alias("bits")).collect()
    filter_words = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    filter_words[[w["place"] for w in words]] = [w["bits"] for w in words]
    masks = sorted(r["mask"] for r in seeds.select("mask").distinct().collect())
    hits = docs.mapInArrow(
        _scan(filter_words, masks, least, similarity), f"doc_id {ids}, text string, p array<long>, seed array<long>"
    )
    hits = stage(hits, "seeds-hits")
    seeds = seeds.select("item_id", "q", "seed")
    each = hits.select("doc_id", F.explode(F.arrays_zip("p", "seed")).alias("h"))
    each = each.select("doc_id", F.col("h.p").alias("p"), F.col("h.seed").alias("seed"))
    shifts = each.join(seeds, "seed").groupBy("doc_id", "item_id").agg(
        F.collect_set(F.col("p") - F.col("q")).alias("shifts")
    )
    texts = hits.select("doc_id", F.col("text").alias("document")).distinct()
    pairs = shifts.join(items.withColumnRenamed("text", "item"), "item_id").join(texts, "doc_id")
    found = pairs.select("doc_id", "item_id", "document", "item", "shifts").mapInArrow(
        _verify(least, similarity),
        f"doc_id {ids}, item_id {item_ids}, n_equal long, start_word long, end_word long",
    )
    best = F.max(F.struct("n_equal", "start_word", "end_word")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")
