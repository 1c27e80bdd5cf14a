"""Removal of long repeated byte strings across documents, by suffix arrays.

A string of LENGTH bytes that starts at two places must be found wherever these
are. Every such window picks one of its short substrings by hash (the least one),
so equal windows pick alike. Neighbouring windows with the same pick make a
stretch, and stretches meet by their pick:

* a pick that occurs once holds nothing repeated, and is dropped;
* equal stretches are repeats as a whole, which a count by hash tells;
* the different stretches of a pick go, one copy each, into a shard, where a
  suffix array is induced and its permuted common prefixes tell which windows
  occur in another stretch.

Shards have a bounded size: many picks share one, and a pick whose stretches have
more bytes than a shard holds is dealt to several. Windows of such a pick that found no
partner in their shard, and one of each kind that did, meet the other shards by a
hash of the window. Documents that are exact copies enter once and are repeats as
a whole. No pick, stretch or copy is left out or capped.

Null is empty; texts shorter than LENGTH lose nothing. Rows are told apart by
their bytes, not their id: copies of a row, with the same or a null id too, count
as copies. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as, stage
from storelens.llm.suffix_arrays import common_prefixes, suffix_array
from storelens.llm.textbytes import CONTINUATION, RangeHash, batch_slices, mix, slices

LENGTH = 400
#: Bytes of the substrings a window picks from.
PICK = 32
#: Bytes of a shard, about; a pick with more than that is dealt to several.
SHARD_BYTES = 1 << 22


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


def stretches(offsets: np.ndarray, data: np.ndarray, length: int, pick: int):
    """(row, pick hash, content hash, first start, last start) of each stretch;
    starts count from the beginning of the row."""
    if len(data) < length:
        return [np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64)]
    ranges = RangeHash(data)
    places = np.arange(len(data) - pick + 1)
    hashes = ranges(places, places + pick)
    # 32 bits of hash before the place: the leftmost of equal ones is picked
    ranked = (hashes >> np.uint64(32) << np.uint64(32)) | places.astype(np.uint64)
    least = _sliding_least(ranked, length - pick + 1)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[row] + offsets[row]
    picked = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(starts):
        return [np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64)]
    begins = np.flatnonzero(np.concatenate([[True], picked[1:] != picked[:-1]]))
    ends = np.append(begins[1:], len(starts)) - 1
    first, last, at, own = starts[begins], starts[ends], picked[begins], row[begins]
    content = mix(ranges(first, last + length) ^ mix((at - first).astype(np.uint64) + np.uint64(9)))
    return own, mix(hashes[at]), content, first - offsets[own], last - offsets[own]


def _stretches(length: int, pick: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["digest"]):
            own, picks, content, first, last = stretches(offsets, data, length, pick)
            # a stretch that a text repeats (periodic text has many) goes out once
            key = mix(picks ^ mix(content ^ mix(own.astype(np.uint64) + np.uint64(3))))
            _, index, times = np.unique(key, return_index=True, return_counts=True)
            order = np.argsort(index)
            index, times = index[order], times[order]
            sizes = np.bincount(own[index], minlength=len(offsets) - 1)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            columns = [
                picks[index].view(np.int64),
                content[index].view(np.int64),
                first[index].astype(np.int32),
                last[index].astype(np.int32),
                times.astype(np.int32),
            ]
            lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), *lists], names=["digest", "pick", "content", "first", "last", "times"]
            )

    return run


def _cut(length: int):
    """The bytes of the wanted stretches of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picks, contents, shards, parts = [], [], [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                for w in wanted:
                    picks.append(w["pick"])
                    contents.append(w["content"])
                    shards.append(w["shard"])
                    parts.append(raw[w["first"] : w["last"] + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(picks, pa.int64()), pa.array(contents, pa.int64()), pa.array(shards, pa.int64()), pa.array(parts, pa.binary())],
                names=["pick", "content", "shard", "part"],
            )

    return run


def repeated_windows(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which starts of the joined parts begin a window that another place shares,
    and of these the ones whose window sorts first of its kind. Part k begins at
    the sum of the sizes before it plus k."""
    joined = np.frombuffer(b"\0".join(parts), dtype=np.uint8)
    text = np.zeros(len(joined) + 1, dtype=np.uint16)
    text[:-1] = joined
    text[:-1] += 2
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[(begins + sizes)[:-1]] = 1  # between parts; the end mark is 0
    wanted = np.zeros(len(text), dtype=bool)
    for begin, size in zip(begins, sizes):
        wanted[begin : begin + size - length + 1] = True
    array = suffix_array(text, 258, length)
    later = common_prefixes(text, array, wanted, length) >= length
    shared = later.copy()
    at = np.flatnonzero(later[array])
    shared[array[at - 1]] = True
    return shared, shared & ~later


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        picks = table.column("pick").to_numpy()
        contents = table.column("content").to_numpy()
        dealt = table.column("dealt").to_numpy()
        parts = table.column("part").to_pylist()
        seen: dict[tuple[int, int], int] = {}
        for i, key in enumerate(zip(picks.tolist(), contents.tolist())):
            seen.setdefault(key, i)
        rows = list(seen.values())
        parts = [parts[i] for i in rows]
        shared, first = repeated_windows(parts, length)
        out: list[tuple] = []
        begin = 0
        for i, part in zip(rows, parts):
            windows = len(part) - length + 1
            own = np.concatenate([[0], shared[begin : begin + windows].astype(np.int8), [0]])
            lows, highs = np.flatnonzero(np.diff(own) == 1), np.flatnonzero(np.diff(own) == -1) - 1
            places, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            if dealt[i]:
                data = np.frombuffer(part, dtype=np.uint8)
                places = np.flatnonzero(~shared[begin : begin + windows] | first[begin : begin + windows])
                values = RangeHash(data)(places, places + length).view(np.int64)
            if len(lows) or len(places):
                out.append((picks[i], contents[i], lows, highs, places, values))
            begin += len(part) + 1
        numbers, places = pa.int64(), pa.list_(pa.int32())
        kinds = (numbers, numbers, places, places, places, pa.list_(numbers))
        columns = list(zip(*out)) or [()] * 6
        return pa.table(
            dict(zip(("pick", "content", "lows", "highs", "places", "windows"), map(pa.array, columns, kinds)))
        )

    return run


def _remove(length: int, pick: int):
    """Cuts the repeated windows out; a text's stretches are found again, so that
    all copies of a stretch inside it are met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept, chars = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                _, picks, content, first, _ = stretches(np.array([0, len(data)]), data, length, pick)
                at: dict[tuple[int, int], list[int]] = {}
                for key in zip(picks.view(np.int64).tolist(), content.view(np.int64).tolist(), first.tolist()):
                    at.setdefault(key[:2], []).append(key[2])
                lows, highs = [], []
                for f in found:
                    starts = at[f["pick"], f["content"]]
                    lows += [s + f["low"] for s in starts]
                    highs += [s + f["high"] for s in starts]
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(edge, lows, 1)
                np.add.at(edge, np.array(highs) + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                left = np.frombuffer(raw, np.uint8)[~gone]
                kept.append(hashlib.sha256(left.tobytes()).hexdigest())
                chars.append(int((~CONTINUATION[left]).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept),
                    pa.array(chars, pa.int64()),
                ],
                names=["digest", "n_removed", "n_spans", "kept_sha256", "n_kept_chars"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, pick: int = PICK
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, changed, n_kept_chars) of
    every row: ``changed`` whether bytes are removed, ``n_kept_chars`` the characters
    that begin among the bytes left."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    docs = docs.withColumn("digest", digest)
    long = docs.where(F.octet_length("text") >= length)
    found = long.select("digest", "text").mapInArrow(
        _stretches(length, pick),
        "digest binary, pick array<long>, content array<long>, first array<int>, last array<int>, times array<int>",
    )
    lists = ["pick", "content", "first", "last", "times"]
    texts = found.groupBy("digest").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in lists])
    texts = stage(texts, "repeats-texts")
    each = texts.select("digest", F.inline(F.arrays_zip(*lists)))
    often = each.groupBy("pick").agg(F.sum("times").alias("k")).where("k > 1").select("pick")
    each = stage(each.join(often, "pick", "left_semi"), "repeats-stretches")

    groups = each.groupBy("pick", "content").agg(
        F.sum("times").alias("k"), F.min(F.struct("digest", "first", "last")).alias("one")
    )
    groups = stage(groups, "repeats-groups")
    size = F.col("one.last") - F.col("one.first") + length
    kinds = groups.groupBy("pick").agg(F.count("*").alias("kinds"), F.sum(size).alias("bytes")).where("kinds > 1")
    kinds = stage(kinds, "repeats-picks")
    parts = F.ceil(F.col("bytes") / SHARD_BYTES)
    total = kinds.agg(F.sum("bytes")).first()[0] or 0
    shards = int(total) // SHARD_BYTES + 1
    dealt = groups.join(kinds, "pick").select(
        F.col("one.digest").alias("digest"),
        F.struct(
            "pick",
            "content",
            F.col("one.first").alias("first"),
            F.col("one.last").alias("last"),
            # a pick's part keeps its shard, whatever else is in it
            F.when(parts > 1, -F.pmod(F.xxhash64("pick", F.pmod(F.xxhash64("content"), parts)), F.lit(1 << 40)) - 1)
            .otherwise(F.pmod(F.xxhash64("pick"), F.lit(shards)))
            .alias("shard"),
        ).alias("w"),
    )
    wanted = dealt.groupBy("digest").agg(F.collect_list("w").alias("wanted"))
    owners = long.groupBy("digest").agg(F.min("doc_id").alias("owner"))
    source = long.join(owners.join(wanted, "digest"), "digest").where(F.col("doc_id").eqNullSafe(F.col("owner")))
    cut = source.select("text", "wanted").mapInArrow(_cut(length), "pick long, content long, shard long, part binary")
    shared = (
        cut.withColumn("dealt", F.col("shard") < 0)
        .groupBy("shard")
        .applyInArrow(
            _shard(length),
            "pick long, content long, lows array<int>, highs array<int>, places array<int>, windows array<long>",
        )
    )
    shared = stage(shared, "repeats-shared")
    within = shared.select("pick", "content", F.inline(F.arrays_zip("lows", "highs")).alias("low", "high"))
    across = shared.select(
        "pick", "content", F.inline(F.arrays_zip("places", "windows")).alias("low", "window")
    ).withColumn("high", F.col("low"))
    met = across.groupBy("pick", "window").agg(F.count("*").alias("k")).where("k > 1").select("pick", "window")
    across = across.join(met, ["pick", "window"], "left_semi").select("pick", "content", "low", "high")
    wholly = groups.where("k > 1").select(
        "pick", "content", F.lit(0).alias("low"), (F.col("one.last") - F.col("one.first")).alias("high")
    )
    repeats = stage(within.union(across).union(wholly), "repeats-windows")
    spans = each.select("digest", "pick", "content").join(repeats, ["pick", "content"])
    single = texts.where("copies = 1").select("digest")
    spans = spans.join(single, "digest", "left_semi").groupBy("digest").agg(
        F.collect_list(F.struct("pick", "content", "low", "high")).alias("found")
    )
    changed = long.join(spans, "digest").select("digest", "text", "found").mapInArrow(
        _remove(length, pick), "digest binary, n_removed long, n_spans long, kept_sha256 string, n_kept_chars long"
    )
    copies = texts.where("copies > 1").select("digest", F.lit(True).alias("copied"))
    rows = docs.select(
        "doc_id",
        "digest",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
    rows = rows.join(copies, "digest", "left").join(changed, "digest", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(empty))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
        (F.coalesce("copied", F.lit(False)) | (F.coalesce("n_removed", F.lit(0)) > 0)).alias("changed"),
        F.when(F.col("copied"), F.lit(0)).otherwise(F.coalesce("n_kept_chars", "n_chars")).cast("long").alias("n_kept_chars"),
    )
