"""Packing documents into training sequences by linear grouping.

Lengths are at most the capacity, so a histogram of lengths says all that packing
needs, however many documents there are; the driver sees that histogram only.

* Large lengths are put, longest first, into groups of equal cardinality, and
  each is rounded up to the largest of its group, which leaves few sizes.
* Configurations of these sizes are chosen by linear programming: columns come
  from a knapsack over the capacity, priced by the duals. The solution is rounded
  down; what that leaves over is packed with the small ones.
* Actual documents take the places of the rounded sizes, and the room they leave
  is filled best-fit, longest first.

The plan consists of classes of sequences with equal contents, so that each place
is a run: the documents of one length with ranks from lo on. Spark ranks the
documents of each length (in buckets, as one length may hold most rows) and looks
up the run of each.

A null or empty text is one end token. Longer documents than the capacity are
cut; nothing else is. Copies of a row and null ids get places of their own; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.bpe_counts import byte_symbols
from storelens.llm.frames import prepared, rows_as, stage
from storelens.llm.textbytes import LOWER, SLICE_BYTES, batch_slices, slices

CAPACITY = 4096
END_ID = 1
#: Lengths above 1/n of the capacity are grouped; of these n the one whose plan
#: has the fewest sequences is taken.
LARGE_SHARES = (2, 4)
GROUPS = 32
#: Parts of words a worker remembers the identifiers of.
REMEMBERED = 600_000
#: Parts of words in one call to the library, whose answer is much larger than they.
CALL = 10_000
#: Rows that share one ranking bucket of a length, about.
BUCKET_ROWS = 20_000


_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[[0x09, 0x0A, 0x0D]] = 0x20
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
# second bytes, after 0xC3, of the letters from U+00C0 to U+00FF
_ACCENTED = np.zeros(256, dtype=bool)
_ACCENTED[0x80:0xC0] = True
_ACCENTED[[0x97, 0xB7]] = False
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


def _binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Neighbouring ranges of bytes, not copied."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int64, copy=False)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


class WordIds:
    """Token identifiers of texts as 32-bit numbers.

    White space separates the words of this kind of vocabulary. The different words
    of a slice are found first (a word has the space after it with it), and of these
    the different parts: letters, lower-cased, and the punctuation that follows them.
    Only parts a worker has not met yet go to the library, many in a call and without
    the normaliser, which has nothing left to do in them. Words of any other make-up
    are one part and go to the library as they are.
    """

    _letters = {byte: symbol for byte, symbol in enumerate(byte_symbols()) if byte != 0x20}

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(vocabulary)
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {b"": 0, b" ": 1}
        self.stops = np.zeros(2, dtype=np.int64)  # where each part's identifiers end
        self.ids = np.zeros(0, dtype="<u4")

    def _merged(self, plain: list[bytes]) -> np.ndarray:
        joined = b" ".join(plain).decode("latin-1").translate(self._letters)
        return np.array(self.merges.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, plain: list[bytes], odd: list[bytes]) -> None:
        found, sizes = [], []
        if plain:
            ids = np.concatenate([self._merged(plain[at : at + CALL]) for at in range(0, len(plain), CALL)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            assert len(stops) == len(plain), "a part is not one word of the vocabulary"
            found.append(ids)
            sizes.append(np.diff(stops, prepend=0))
        if odd:
            words = [word.removesuffix(b" ").decode() for word in odd]
            own = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
            found += [np.array(ids, dtype="<u4") for ids in own]
            sizes.append(np.array([len(ids) for ids in own], dtype=np.int64))
        for place, part in enumerate(plain + odd, len(self.places)):
            self.places[part] = place
        self.stops = np.concatenate([self.stops, len(self.ids) + np.cumsum(np.concatenate(sizes))])
        self.ids = np.concatenate([self.ids, *found])

    def _places_of(self, parts: list[bytes], odd: np.ndarray) -> np.ndarray:
        new = [i for i, part in enumerate(parts) if part not in self.places]
        if len(self.places) + len(new) > REMEMBERED:
            self._forget()
            new = [i for i, part in enumerate(parts) if part not in self.places]
        if new:
            self._learn([parts[i] for i in new if not odd[i]], [parts[i] for i in new if odd[i]])
        return np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts))

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """The identifiers of each of some different words."""
        _, ends, values = words.buffers()
        offsets = np.frombuffer(ends, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(values, dtype=np.uint8)[: offsets[-1]]
        begins = offsets[:-1]
        second = np.zeros(len(data), dtype=bool)
        second[1:] = _ACCENTED[data[1:]] & (data[:-1] == 0xC3)
        second[begins] = False
        accented = np.flatnonzero(second)
        letter = _LETTER[data]
        letter[accented] = letter[accented - 1] = True
        mark = _MARK[data]
        back = np.zeros(len(data), dtype=bool)  # to letters after punctuation
        back[1:] = letter[1:] & mark[:-1]
        back[begins] = False
        strange = np.flatnonzero(back | ~(letter | mark | (data == 0x20)))
        odd = np.zeros(len(words), dtype=bool)
        odd[np.searchsorted(offsets, strange, "right") - 1] = True

        lower = LOWER[data]
        capital = accented[data[accented] < 0x9F]
        lower[capital] += 0x20
        raw = np.repeat(odd, np.diff(offsets))
        lower[raw] = data[raw]
        cuts = np.empty(2 * len(words) + 1, dtype=np.int64)
        cuts[::2] = offsets
        cuts[1::2] = begins + np.where(odd, 0, np.add.reduceat(letter, begins, dtype=np.int64))
        coded = _binaries(cuts, lower).dictionary_encode()
        parts = coded.indices.to_numpy()
        odd_parts = np.zeros(len(coded.dictionary), dtype=bool)
        odd_parts[parts[1::2][odd]] = True
        places = self._places_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), odd_parts)[parts]
        sizes = np.diff(self.stops, prepend=0)[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(self.stops[places] - ends[1:], sizes)
        return pa.LargeListArray.from_arrays(pa.array(ends[::2]), pa.array(self.ids[at]))

    def arrays(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers, where those of each row begin and the last one's end) of
        rows of UTF-8 bytes."""
        if not len(data):
            return np.zeros(0, dtype="<u4"), np.zeros(len(offsets), dtype=np.int64)
        data = _BLANKS[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:] = data == 0x20
        cut[offsets] = True
        cuts = np.flatnonzero(cut)
        coded = _binaries(cuts, data).dictionary_encode()
        found = self._ids_of(coded.dictionary).take(coded.indices)
        ends = found.offsets.to_numpy()
        return found.values.to_numpy(), ends[np.searchsorted(cuts, offsets)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for _, offsets, data in slices(pa.array(texts, pa.string()), SLICE_BYTES):
            ids, ends = self.arrays(offsets, data)
            for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield ids[begin:end].tobytes()


_known: dict[str, WordIds] = {}


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches together that make a slice: larger slices repeat more of their words."""
    own, size = [], 0
    for batch in batches:
        if own and size + batch.nbytes > SLICE_BYTES:
            yield pa.concat_batches(own)
            own, size = [], 0
        own.append(batch)
        size += batch.nbytes
    if own:
        yield pa.concat_batches(own)


def _pieces(vocabulary: str, capacity: int):
    end = struct.pack("<I", END_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _known:
            _known[vocabulary] = WordIds(vocabulary)
        for kept, offsets, data in batch_slices(_gathered(batches), "text", ["doc_id"]):
            ids, ends = _known[vocabulary].arrays(offsets, data)
            rows, piece, start, length, crc = [], [], [], [], []
            for row, (begin, stop) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                # the end token comes after the last identifier
                for k, at in enumerate(range(begin, stop + 1, capacity)):
                    last = at + capacity > stop
                    code = zlib.crc32(ids[at : min(at + capacity, stop)])
                    rows.append(row)
                    piece.append(k)
                    start.append(at - begin)
                    length.append(stop + 1 - at if last else capacity)
                    crc.append(zlib.crc32(end, code) if last else code)
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(c, pa.int64()) for c in (start, length, crc)],
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def group_lengths(counts: np.ndarray, large: int, groups: int) -> list[list[tuple[int, int]]]:
    """Runs (length, count) of the lengths from ``large`` on, longest first, dealt
    to groups of equal cardinality."""
    lengths = [int(n) for n in np.flatnonzero(counts) if n >= large][::-1]
    total = int(sum(counts[n] for n in lengths))
    each = max(-(-total // groups), 1)
    dealt: list[list[tuple[int, int]]] = [[]]
    room = each
    for n in lengths:
        left = int(counts[n])
        while left:
            if not room:
                dealt.append([])
                room = each
            took = min(left, room)
            dealt[-1].append((n, took))
            left, room = left - took, room - took
    return [g for g in dealt if g]


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits (unbounded knapsack)."""
    unit = int(np.gcd.reduce([*sizes, capacity]))
    room = capacity // unit
    small = np.array(sizes) // unit
    rising = np.argsort(small, kind="stable")
    widths, worth = small[rising], values[rising]
    fitting = np.searchsorted(widths, np.arange(room + 1), "right")
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(int(widths[0]), room + 1):
        n = fitting[r]
        found = best[r - widths[:n]] + worth[:n]
        i = int(found.argmax())
        if found[i] > best[r - 1] + 1e-12:
            best[r], last[r] = found[i], rising[i]
        else:
            best[r] = best[r - 1]
    chosen, r = np.zeros(len(sizes)), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            chosen[last[r]] += 1
            r -= small[last[r]]
    return float(best[room]), chosen


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, turns: int = 400):
    """(configuration, how many sequences) by column generation; whole numbers."""
    columns = np.diag([float(capacity // s) for s in sizes])
    inverse = np.linalg.inv(columns)
    amounts = inverse @ demand
    for _ in range(turns):
        duals = np.ones(len(sizes)) @ inverse
        value, column = _best_configuration(sizes, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaves]):
            break
        columns[:, leaves] = column
        inverse = np.linalg.inv(columns)
        amounts = np.maximum(inverse @ demand, 0)
    return [(columns[:, j].astype(int), int(amounts[j] + 1e-9)) for j in range(len(sizes)) if amounts[j] >= 1 - 1e-9]


class Plan:
    """Classes of sequences with equal contents, and the runs of each length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        # by what is left: (how many, [(length, copies)])
        self.room: dict[int, list[tuple[int, list]]] = {}
        self.rooms: list[int] = []

    def put(self, many: int, left: int, contents: list) -> None:
        if not many:
            return
        if left not in self.room:
            self.room[left] = []
            insort(self.rooms, left)
        self.room[left].append((many, contents))

    def take(self, length: int) -> tuple[int, int, list] | None:
        """A class with the least room that is enough."""
        place = bisect_left(self.rooms, length)
        if place == len(self.rooms):
            return None
        left = self.rooms[place]
        many, contents = self.room[left].pop()
        if not self.room[left]:
            del self.room[left]
            self.rooms.pop(place)
        return many, left, contents

    def fit(self, length: int, count: int) -> None:
        """Best fit of ``count`` documents of a length. The sequence that got one
        has the least room then, so it takes as many as it holds."""
        while count:
            many, left, contents = self.take(length) or (count, self.capacity, [])
            copies = left // length
            whole = min(many, count // copies)
            self.put(whole, left - copies * length, [*contents, (length, copies)])
            count -= whole * copies
            if whole < many and count:
                self.put(1, left - count * length, [*contents, (length, count)])
                count, whole = 0, whole + 1
            if contents:
                self.put(many - whole, left, contents)

    def size(self) -> int:
        return sum(many for own in self.room.values() for many, _ in own)

    def runs(self) -> dict[str, np.ndarray]:
        """Sorted by length and first rank: where ranks lo... of a length go."""
        rows, first, base = [], {}, 0
        for left in self.rooms:
            for many, contents in self.room[left]:
                offset = 0
                for length, copies in contents:
                    lo = first.get(length, 0)
                    first[length] = lo + many * copies
                    rows.append((length, lo, base, copies, offset))
                    offset += length * copies
                base += many
        self.sequences = base
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        return dict(zip(("length", "lo", "base", "copies", "offset"), table.T))


def make_plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """``counts``: how many documents have each length from 0 to the capacity."""
    plans = [_plan_for(counts, capacity, groups, share) for share in LARGE_SHARES]
    return min(plans, key=Plan.size)


def _plan_for(counts: np.ndarray, capacity: int, groups: int, share: int) -> Plan:
    plan = Plan(capacity)
    left = counts.copy()
    plan.put(int(left[capacity]), 0, [(capacity, 1)])
    left[capacity] = 0
    dealt = group_lengths(left, capacity // share + 1, groups)
    if dealt:
        sizes = [group[0][0] for group in dealt]
        demand = np.array([sum(n for _, n in group) for group in dealt], dtype=float)
        merged = sorted(set(sizes), reverse=True)  # groups of one length are one size
        pools = {s: [] for s in merged}
        for size, group in zip(sizes, dealt):
            pools[size] += group
        wanted = np.array([demand[[s == m for s in sizes]].sum() for m in merged])
        for config, many in configurations(merged, wanted, capacity):
            for width, contents in _substitute(config, many, merged, pools, left):
                used = sum(length * copies for length, copies in contents)
                plan.put(width, capacity - used, contents)
    for length in np.flatnonzero(left)[::-1]:
        plan.fit(int(length), int(left[length]))
    return plan


def _substitute(config: np.ndarray, many: int, sizes: list[int], pools: dict, left: np.ndarray):
    """Actual lengths for ``many`` sequences of a configuration, as (how many,
    contents); a place whose group is used up stays free."""
    places = []
    for size, copies in zip(sizes, config):
        for _ in range(copies):
            need, own = many, []
            while need and pools[size]:
                length, count = pools[size][-1]
                took = min(need, count)
                pools[size][-1:] = [(length, count - took)] if count > took else []
                left[length] -= took
                own.append((length, took))
                need -= took
            places.append(own + ([(0, need)] if need else []))
    while many:
        width = min(own[0][1] for own in places)
        yield width, [(own[0][0], 1) for own in places if own[0][0]]
        for own in places:
            length, count = own[0]
            own[:1] = [(length, count - width)] if count > width else []
        many -= width


def _place(runs: dict[str, np.ndarray]):
    # one sorted key for (length, rank): ranks are below 2^48, lengths below 2^14
    keys = (runs["length"] << 48) + runs["lo"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            beyond = rank - runs["lo"][at]
            copies = runs["copies"][at]
            sequence = runs["base"][at] + beyond // copies
            offset = runs["offset"][at] + beyond % copies * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.
    ``vocabulary`` is the path of the tokenizer file on each machine."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]
    kinds = f"doc_id {ids}, piece int, start long, length long, ids_crc32 long"
    pieces = stage(docs.mapInArrow(_pieces(vocabulary, capacity), kinds), "packing-pieces")
    # at most ``capacity`` lengths, whatever the number of documents
    seen = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in seen:
        counts[row["length"]] = row["count"]
    plan = make_plan(counts, capacity)
    runs = plan.runs()
    buckets = 8 + int(counts.sum()) // BUCKET_ROWS
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    pieces = pieces.withColumn("bucket", spread)
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("k"))
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.withColumn("place", F.row_number().over(within) - 1).join(sizes, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("earlier")).alias("rank")
    )
    return ranked.mapInArrow(_place(runs), f"{kinds}, sequence_id long, offset long")
