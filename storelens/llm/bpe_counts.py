"""Token counts of a byte-level BPE vocabulary, by merging with a heap.

A piece of text starts as a linked list of byte symbols. A heap holds its
adjacent pairs by rank; the lowest one is merged, its neighbours form new pairs,
and entries whose symbols have changed since are skipped when popped. The count
is the number of initial symbols less the merges; identifiers are never made.
One piece of n bytes takes n log n steps, however long it is.

Pieces are cut by the vocabulary's rule. A space belongs to the word after it, so
texts without doubled white space can be cut at spaces and line ends alone, and
the count of such a word is remembered within a worker, up to a fixed number of
words. Other texts are cut by the full pattern. A special token inside a text
counts as one, as the library has it by default.

Null and empty texts have no tokens. One row comes out per row, copies and null
ids included; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from storelens.llm.frames import prepared, rows_as

#: Words whose counts a worker remembers.
REMEMBERED = 700_000

#: Cuts a text into pieces; fixed by the vocabulary.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

_SHIFT = 17  # symbol identifiers are below 2^17
_IRREGULAR = 1 << 50  # marks a word that can't be counted on its own


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself
    if it is visible, else the next free one from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    names = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Merger:
    """Counts the tokens of pieces and texts for one vocabulary file."""

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED):
        with open(vocabulary, encoding="utf-8") as file:
            stored = json.load(file)
        ids = stored["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in stored["model"]["merges"]]
        self.pairs = {
            ids[a] << _SHIFT | ids[b]: rank << _SHIFT | ids[a + b] for rank, (a, b) in enumerate(merges)
        }
        self.bytes = [ids[c] for c in byte_symbols()]
        self.pieces = regex.compile(PIECES)
        special = [t["content"] for t in stored["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        self.marks = special
        self.known = _Remembered(lambda piece: self.merge_count(piece.encode()), remembered)
        self.first = _Remembered(lambda word: self._word(word), remembered)
        self.spaced = _Remembered(lambda word: self._word(" " + word) if word else _IRREGULAR, remembered)

    def merge_count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        symbols = [self.bytes[b] for b in piece]
        n = len(symbols)
        if n < 2:
            return n
        pairs, mask = self.pairs, (1 << _SHIFT) - 1
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        heap = []
        for i in range(n - 1):
            found = pairs.get(symbols[i] << _SHIFT | symbols[i + 1])
            if found is not None:
                heap.append((found >> _SHIFT, i))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = pairs.get(symbols[i] << _SHIFT | symbols[j])
            if found is None or found >> _SHIFT != rank:
                continue
            merges += 1
            symbols[i], symbols[j] = found & mask, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = pairs.get(symbols[i] << _SHIFT | symbols[k])
                if found is not None:
                    heapq.heappush(heap, (found >> _SHIFT, i))
            h = before[i]
            if h >= 0:
                found = pairs.get(symbols[h] << _SHIFT | symbols[i])
                if found is not None:
                    heapq.heappush(heap, (found >> _SHIFT, h))
        return n - merges

    def _word(self, word: str) -> int:
        """Tokens of a word between single spaces or line ends."""
        bare = word[1:] if word[:1] == " " else word
        if bare and (_white(bare[0]) or _white(bare[-1])):
            return _IRREGULAR
        return sum(map(self.known.__getitem__, self.pieces.findall(word)))

    def _by_pattern(self, text: str) -> int:
        return sum(self.merge_count(p.encode()) for p in self.pieces.findall(text))

    def _plain(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        if not text:
            return 0
        lines = text.split("\n")
        total = len(lines) - 1
        if len(lines) > 1 and not lines[-1] and lines[-2]:
            lines.pop()  # one line end after a word at the end of the text
        for line in lines:
            if not line:
                return self._by_pattern(text)
            head, *words = line.split(" ")
            total += (self.first[head] if head else _IRREGULAR) + sum(map(self.spaced.__getitem__, words))
        return total if total < _IRREGULAR else self._by_pattern(text)

    def count(self, text: str) -> int:
        if any(mark in text for mark in self.marks):
            parts = self.special.split(text)
            return sum(map(self._plain, parts)) + len(parts) - 1
        return self._plain(text)


class _Remembered(dict):
    """Results of a function, forgotten together when there are too many."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _white(char: str) -> bool:
    return char.isspace() or char in "\x85᠎"


_mergers: dict[str, Merger] = {}


def merger(vocabulary: str) -> Merger:
    """One per worker and file."""
    if vocabulary not in _mergers:
        _mergers[vocabulary] = Merger(vocabulary)
    return _mergers[vocabulary]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row. ``vocabulary`` is the
    path of the tokenizer file on each machine."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merger(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.mapInArrow(run, f"doc_id {ids}, n_bytes long, n_tokens long, over_limit boolean")
