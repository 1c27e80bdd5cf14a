"""SentencePiece encoding and decoding through a table of distinct chunks.

In a vocabulary in which no piece has a white-space marker after another
character, no merge crosses from a word to the marker behind it. A text therefore
falls into marked words, its chunks: a run of markers with the characters up to
the next one. Where no piece has a line end inside, chunks also end at line ends.
The chunks of a batch of texts that the table lacks are segmented together, each
distinct one once, by the tokenizer library; the table keeps a chunk's ids and the
text they decode to. A text is encoded by looking its chunks up and joining their
ids in the order of their places, and decoded by joining what these stand for,
less the marker that encoding puts in front.

A worker's table is begun anew when it holds more than ``TABLE_CHUNKS``; chunks
longer than ``KEPT_CHARS`` stay in it for their batch only. Texts are cut whole.
Vocabularies that break a condition, or normalise texts, are refused.

Null and empty texts have no ids. One row comes out per row, copies and null ids
included; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from storelens.llm.frames import prepared, rows_as
from storelens.llm.textbytes import SLICE_BYTES

MARK = "▁"

#: Chunks a worker's table holds, and the longest that it keeps.
TABLE_CHUNKS, KEPT_CHARS = 1_000_000, 100

# What a model without normalisation leaves as it is.
_PROBE = "  a  ﬁ　① é\tＡ  "


class Encoder:
    """Texts to ids and back through one table of distinct chunks."""

    def __init__(self, path: str, limit: int = TABLE_CHUNKS):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.limit = limit
        self.segmented = 0  # chunks handed to the model
        #: chunk: number of ids, the ids joined by commas, the text they decode to
        self.table: dict[str, tuple[int, str, str]] = {}
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece crosses a white-space marker")
        if model.decode(model.encode(_PROBE)) != _PROBE or len(model.encode("\n")) != 2:
            raise ValueError("the vocabulary normalises texts or has no byte pieces")
        lines = not any("\n" in p for p in pieces)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+" if lines else f"{MARK}+[^{MARK}]*")

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text in order, a marker put in front of it."""
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def _segment(self, chunks: list[str]) -> None:
        """Put chunks into the table. The model itself adds a marker in front; a
        chunk without one stands behind a line end, whose ids are dropped."""
        marked = [chunk[0] == MARK for chunk in chunks]
        texts = [chunk[1:] if m else "\n" + chunk for chunk, m in zip(chunks, marked)]
        ids = self.model.encode(texts, num_threads=1)
        # the model has no ids for a text without characters: one marker by itself
        alone = self.model.piece_to_id(MARK)
        ids = [(own or [alone]) if m else own[2:] for own, m in zip(ids, marked)]
        surfaces = self.model.decode(ids, num_threads=1)
        for chunk, own, m, surface in zip(chunks, ids, marked, surfaces):
            self.table[chunk] = (len(own), ",".join(map(str, own)), " " + surface if m else surface)
        self.segmented += len(chunks)

    def encode(self, texts: Iterable[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, the ids joined by commas, and the text
        that they decode to."""
        table = self.table
        if len(table) > self.limit:
            table.clear()
        cut = [self.chunks(text) for text in texts]
        lacking = set().union(*cut).difference(table)
        if lacking:
            self._segment(list(lacking))
        found = []
        for chunks in cut:
            counts, ids, surfaces = zip(*map(table.__getitem__, chunks)) if chunks else ((), (), ())
            found.append((sum(counts), ",".join(ids), "".join(surfaces)[1:]))
        for chunk in lacking:
            if len(chunk) > KEPT_CHARS:
                del table[chunk]
        return found


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive rows of a few megabytes of text, so that memory follows the
    longest text, not the batch."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > SLICE_BYTES:
            yield start, row
            start, held = row, 0
        held += size
    if sizes:
        yield start, len(sizes)


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row, ``ids`` an array and ``decoded``
    the text made from them. With ``digests`` their SHA-256 instead (ids_sha256 of
    the decimal ids joined by commas, decoded_sha256). ``model`` is the path of the
    file on each machine."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            for start, stop in _slices(batch.column(1)):
                rows = coder.encode(t or "" for t in batch.column(1).slice(start, stop - start).to_pylist())
                counts, ids, decoded = zip(*rows)
                if digests:
                    ids, decoded = list(map(_sha256, ids)), list(map(_sha256, decoded))
                else:
                    ids = [[int(i) for i in own.split(",") if i] for own in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.string() if digests else pa.list_(pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    names=names,
                )

    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, {rest}")
