"""Near-duplicate documents by circulant MinHash, banding and exact confirmation.

Two permutations make all coordinates of a signature: the first scatters the
shingles over the places of a circle, the second numbers the places, and
coordinate k is the smallest number met when the circle is turned by k. Bands of
neighbouring coordinates are the buckets candidates come from; a link is
confirmed by the Jaccard similarity of the whole shingle sets.

Equal sets are one class from the start. Then each class is compared with one
other, the smallest it shares a bucket with, and the links are closed to
components. A bucket whose members are all connected is done. The members of the
other buckets meet once more in blocks: a task gets a bucket, or two parts of a
large one, and compares members of different components that have one of their
rarest shingles in common, which similar sets must have; pairs are never rows of a
table. No bucket is capped, and every candidate pair is either compared, known to
be connected, or known to differ.

Nulls, empty texts and texts of white space have no shingles: they link with
nothing and are their own component. Rows without an id are returned with a null
component, not kept, and link nothing. Copies of a row, with the same id too,
are one class. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import components, prepared, rows_as, stage
from storelens.llm.textbytes import LOWER, RangeHash, batch_slices, find_words, mix, slices, window_hashes

BANDS, ROWS = 36, 5
CIRCLE_BITS = 20
#: A block of an open bucket has about this many members and shingles at most.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_500_000


def _circle(coordinates: int) -> np.ndarray:
    places = np.random.Generator(np.random.PCG64(7)).permutation(1 << CIRCLE_BITS).astype(np.uint32)
    return np.concatenate([places, places[: coordinates - 1]])


def shingle_sets(offsets: np.ndarray, data: np.ndarray, words: int) -> list[np.ndarray]:
    """For each row the sorted 64-bit hashes of its distinct word shingles."""
    data = LOWER[data]
    found = find_words(offsets, data)
    hashes = RangeHash(data)(found.starts, found.ends)
    runs = window_hashes(hashes, words)
    sets = []
    for begin, end in zip(found.first[:-1], found.first[1:]):
        if end - begin >= words:
            sets.append(np.unique(runs[begin : end - words + 1]))
        elif end > begin:  # fewer words: the whole sequence is the one shingle
            sets.append(window_hashes(hashes[begin:end], end - begin) ^ np.uint64(end - begin))
        else:
            sets.append(hashes[:0])
    return sets


def _scatter(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)


def _signature(shingles: np.ndarray, turned: np.ndarray) -> np.ndarray:
    least = np.full(turned.shape[1], np.iinfo(np.uint32).max, dtype=np.uint32)
    places = _scatter(shingles)
    for i in range(0, len(places), 4096):
        np.minimum(least, turned[places[i : i + 4096]].min(axis=0), out=least)
    return least


def _sign(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = bands * rows
        turned = np.lib.stride_tricks.sliding_window_view(_circle(count), count)
        factors = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 62, (bands, rows), dtype=np.uint64)
        factors = factors * np.uint64(2) + np.uint64(1)
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id"]):
            sets = shingle_sets(offsets, data, words)
            keys = np.zeros((len(sets), bands), dtype=np.uint64)
            for i, own in enumerate(sets):
                if len(own):
                    parts = _signature(own, turned).reshape(bands, rows).astype(np.uint64)
                    keys[i] = mix((mix(parts + np.uint64(1)) * factors).sum(axis=1, dtype=np.uint64))
            full = np.array([len(own) > 0 for own in sets], dtype=bool)
            ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            digests = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None for own in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def _confirm(words: int, percent: int):
    def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
        for _, offsets, data in slices(column):
            yield from shingle_sets(offsets, data, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(sets_of(batch.column(2)), sets_of(batch.column(3))):
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(two) - common) and common > 0)
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; kept where the id is
    the smallest of its component. ``percent`` is the least Jaccard similarity."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]
    signed = docs.mapInArrow(
        _sign(words, bands, rows), f"doc_id {ids}, n_shingles long, digest binary, bands array<long>"
    )
    signed = stage(signed, "minhash-signed")
    classes = stage(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "minhash-classes",
    )
    band_rows = classes.select("rep", "n", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "rep", "n"
    )
    shared = band_rows.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    members = stage(band_rows.join(shared.select("bucket"), "bucket", "left_semi"), "minhash-buckets")
    owners = members.select("rep").distinct()
    texts = docs.join(owners, docs.doc_id == owners.rep, "left_semi").distinct()
    texts = stage(texts.withColumnRenamed("doc_id", "rep"), "minhash-texts")
    comp = _linked(members, texts, words, percent, ids)
    roots = classes.select("digest", "rep").join(
        comp.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("digest", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def _linked(members: DataFrame, texts: DataFrame, words: int, percent: int, ids: str) -> DataFrame:
    """Components of the classes that share buckets."""
    similar = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (F.col("rep") != F.col("rep2"))
    centre = members.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("c"))
    met = members.join(centre, "bucket").select("rep", "n", F.col("c.rep").alias("rep2"), F.col("c.n").alias("n2"))
    best = met.where(similar).groupBy("rep").agg(F.min("rep2").alias("rep2"))
    pairs = best.join(texts, "rep").withColumnRenamed("text", "text1")
    pairs = pairs.join(texts.toDF("rep2", "text2"), "rep2").select("rep", "rep2", "text1", "text2")
    links = stage(pairs.mapInArrow(_confirm(words, percent), f"a {ids}, b {ids}"), "minhash-links")
    comp = stage(components(links, "minhash-first").toDF("rep", "comp"), "minhash-components")

    named = members.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    several = named.groupBy("bucket").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("total")
    ).where("lo < hi")
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    open_rows = named.join(several.select("bucket", parts.alias("parts")), "bucket")
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    open_rows = open_rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    open_rows = open_rows.select(
        "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "rep", "comp"
    )
    blocks = open_rows.join(texts, "rep").groupBy("bucket", "p", "q")
    more = stage(blocks.applyInArrow(_compare_block(words, percent), f"a {ids}, b {ids}"), "minhash-more-links")
    return components(links.union(more.distinct()), "minhash-last")


def _compare_block(words: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = []
        for _, offsets, data in slices(table.column("text").combine_chunks()):
            sets.extend(shingle_sets(offsets, data, words))
        reps = table.column("rep").to_numpy()
        comps = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1]
        part = table.column("own").to_numpy()
        one, two = _block_links(sets, comps, part, percent)
        return pa.table({"a": pa.array(reps[one]), "b": pa.array(reps[two])})

    return run


def _rare_first(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets as numbers, rare ones first within each set, and
    where each set begins. A number is smaller the fewer sets have the shingle."""
    sizes = np.array([len(s) for s in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(place)
    number = np.empty(len(often), dtype=np.int64)
    number[np.argsort(often, kind="stable")] = np.arange(len(often))
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens = number[place]
    return tokens[np.lexsort((tokens, owner))], np.concatenate([[0], np.cumsum(sizes)])


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all ranges first .. last - 1, one after the other."""
    sizes = last - first
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def _postings(
    tokens: np.ndarray, first: np.ndarray, members: np.ndarray, prefix: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the members' prefixes in order, and whose they are."""
    places = _ranges(first[members], first[members] + prefix)
    order = np.argsort(tokens[places], kind="stable")
    return tokens[places][order], np.repeat(members, prefix)[order]


def _met(postings: tuple[np.ndarray, np.ndarray], probe: np.ndarray) -> np.ndarray:
    """Members that have one of the probe's tokens, once for each."""
    keys, owners = postings
    return owners[_ranges(np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right"))]


def _block_links(
    sets: list[np.ndarray], comps: np.ndarray, part: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of different components (and parts, if there are two).

    The smaller set of a link has 2t / (1 + t) of its shingles in common at least,
    the larger one t of them. Of the shingles in the order of their rarity, the
    first ones of both, as many as may be missing and one more, therefore have one
    in common. Members are indexed by these and only those that meet there are
    compared. One link to each component is enough.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, first = _rare_first(sets)
    indexed = sizes - -(-2 * percent * sizes // (100 + percent)) + 1
    probed = sizes - -(-percent * sizes // 100) + 1
    everyone = np.arange(len(sets))
    most = comps == np.bincount(comps).argmax()
    # members of the largest component, often most of a bucket, are only looked up:
    # by what smaller sets are indexed by, and as larger sets by what they probe with
    smaller = _postings(tokens, first, everyone, indexed)
    larger = _postings(tokens, first, everyone[most], probed[most])
    two_parts = len(np.unique(part)) > 1
    marked = np.zeros(int(tokens.max(initial=-1)) + 1, dtype=bool)
    one, two = [], []
    for i in everyone[~most]:
        own = tokens[first[i] : first[i + 1]]
        met = _met(smaller, own[: probed[i]])
        met = met[(sizes[met] < sizes[i]) | ((sizes[met] == sizes[i]) & ((met < i) | most[met]))]
        above = _met(larger, own[: indexed[i]])
        met = np.unique(np.concatenate([met, above[sizes[above] >= sizes[i]]]))
        fits = (comps[met] != comps[i]) & (100 * np.minimum(sizes[met], sizes[i]) >= percent * np.maximum(sizes[met], sizes[i]))
        if two_parts:
            fits &= part[met] != part[i]
        met = met[fits]
        if not len(met):
            continue
        marked[own] = True
        starts = np.concatenate([[0], np.cumsum(sizes[met])[:-1]])
        common = np.add.reduceat(marked[tokens[_ranges(first[met], first[met + 1])]], starts, dtype=np.int64)
        marked[own] = False
        found = met[100 * common >= percent * (sizes[met] + sizes[i] - common)]
        found = found[np.unique(comps[found], return_index=True)[1]]
        one += [i] * len(found)
        two += found.tolist()
    return np.array(one, dtype=np.int64), np.array(two, dtype=np.int64)
