"""Fill-in-the-middle texts by rotating blocks in place.

A text is cut into units, runs of ASCII letters and single other characters. One
scan over the bytes of a batch finds where units begin; the two cuts follow from a
hash of the document's id. The text with its three sentinels is laid out once in a
bytearray, ``<P>`` prefix ``<M>`` middle ``<S>`` suffix, and the block from
``<M>`` on (psm) or the whole (spm) has its two segments exchanged by three
reversals:

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

``restore`` finds the sentinels, rotates back and takes them out. A sentinel begins
and ends with characters that occur nowhere else in it, so none can arise where a
segment meets one, and a text that holds a sentinel stays plain.

Every row stands for itself. A null text is empty and stays plain; a null id is
hashed as an empty number; copies of a document with one id are transformed alike;
columns other than id and text are ignored. One text is held in memory at a time,
besides its batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storelens.llm.frames import prepared, rows_as
from storelens.llm.textbytes import CONTINUATION, batch_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)

#: Of 100 texts, how many are transformed, and of 100 of these, how many as spm.
TRANSFORMED, AS_SPM = 90, 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def unit_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where units begin in the bytes of several texts."""
    letter = _LETTER[data]
    inner = CONTINUATION[data]
    inner[1:] |= letter[1:] & letter[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    inner[edges] = False
    return np.flatnonzero(~inner)


def rotate(block: np.ndarray, start: int, cut: int, end: int) -> None:
    """Exchange block[start:cut] and block[cut:end] in place by three reversals."""
    for a, b in ((start, cut), (cut, end), (start, end)):
        part = block[a:b]
        half = len(part) // 2
        if half:
            head = part[:half].copy()
            part[:half] = part[: -half - 1 : -1]
            part[-half:] = head[::-1]


def transform(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text cut at two bytes, in the given form."""
    if form == "plain":
        return bytearray(text)
    out = bytearray(len(text) + 9)
    out[:3] = PREFIX
    out[3 : first + 3] = text[:first]
    out[first + 3 : first + 6] = MIDDLE
    out[first + 6 : second + 6] = text[first:second]
    out[second + 6 : second + 9] = SUFFIX
    out[second + 9 :] = text[second:]
    block = np.frombuffer(out, np.uint8)
    if form == "psm":
        rotate(block, first + 3, second + 6, len(out))
    else:
        rotate(block, 0, second + 6, len(out))
    return out


def restore(output: bytes, form: str) -> bytearray:
    """The text that ``transform`` was given."""
    out = bytearray(output)
    if form == "plain":
        return out
    block = np.frombuffer(out, np.uint8)
    suffix, middle = out.find(SUFFIX), out.find(MIDDLE)
    if form == "psm":
        # suffix and middle change places again
        rotate(block, suffix, middle, len(out))
    else:
        # the suffix goes back behind prefix and middle
        rotate(block, 0, out.find(PREFIX), len(out))
    del block
    for mark in SENTINELS:
        at = out.find(mark)
        del out[at : at + len(mark)]
    return out


def draws(doc_id: object, seed: str = "1") -> list[int]:
    """Four numbers of 32 bits from the hash of an id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(key.encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def _form(text: bytes, h3: int, h4: int) -> str:
    if not text or h3 % 100 >= TRANSFORMED or any(mark in text for mark in SENTINELS):
        return "plain"
    return "spm" if h4 % 100 < AS_SPM else "psm"


def _rows(ids: list, offsets: np.ndarray, data: np.ndarray, seed: str) -> Iterator[tuple]:
    """(n, form, output, prefix characters, middle characters) of each text."""
    starts = unit_starts(offsets, data)
    first_unit = np.searchsorted(starts, offsets)
    characters = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~CONTINUATION[data], out=characters[1:])
    for i, doc_id in enumerate(ids):
        low, high = int(offsets[i]), int(offsets[i + 1])
        text = data[low:high].tobytes()
        n = int(first_unit[i + 1] - first_unit[i])
        h1, h2, h3, h4 = draws(doc_id, seed)
        form = _form(text, h3, h4)
        if form == "plain":
            yield n, form, transform(text, 0, 0, form), None, None
            continue
        units = sorted((h1 % (n + 1), h2 % (n + 1)))
        cuts = [int(starts[first_unit[i] + u]) if u < n else high for u in units]
        out = transform(text, cuts[0] - low, cuts[1] - low, form)
        chars = characters[[low, *cuts]]
        yield n, form, out, int(chars[1] - chars[0]), int(chars[2] - chars[1])


_COLUMNS = "n long, form string, prefix_chars long, middle_chars long"


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", digests: bool = False
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row, ``output``
    the transformed text. With ``digests``, instead of the text, its SHA-256 and that
    of the text restored from it (output_sha256, restored_sha256)."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id"]):
            found = list(_rows(kept.column(0).to_pylist(), offsets, data, seed))
            n, form, outputs, prefix, middle = zip(*found)
            columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            if digests:
                back = [hashlib.sha256(restore(o, f)).hexdigest() for o, f in zip(outputs, form)]
                columns += [pa.array([hashlib.sha256(o).hexdigest() for o in outputs]), pa.array(back)]
            else:
                columns.append(pa.array([bytes(o) for o in outputs], pa.binary()).cast(pa.string()))
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
            names += ["output_sha256", "restored_sha256"] if digests else ["output"]
            yield pa.RecordBatch.from_arrays([kept.column(0), *columns], names=names)

    texts = "output_sha256 string, restored_sha256 string" if digests else "output string"
    return docs.mapInArrow(run, f"doc_id {ids}, {_COLUMNS}, {texts}")


def restored(transformed: DataFrame) -> DataFrame:
    """(doc_id, text) again from what ``fill_in_middle`` returned. Null outputs,
    which it never returns, give empty texts; other columns are ignored."""
    prepared(transformed.sparkSession)
    rows = rows_as(transformed, doc_id="doc_id", form="form", text="output")
    ids = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id", "form"]):
            texts = [
                bytes(restore(data[offsets[i] : offsets[i + 1]].tobytes(), form or "plain"))
                for i, form in enumerate(kept.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"]
            )

    return rows.mapInArrow(run, f"doc_id {ids}, text string")
