"""Quality rules as weak supervision.

Rules look at a document and vote good, bad or abstain. How far each rule can be
trusted is not set by hand: expectation-maximisation over the vote patterns of
all documents estimates, for either class, how often a rule gives each vote, and
the posterior probability of the good class decides. A pattern is one of at most
3^(number of rules), so the estimation sees counts of patterns, never rows.

Documents that fail the base rules (too few words, too many words in repeated
windows) are never kept, and the estimation runs over the others, for which the
votes decide. A null text has no words. An empty table gives an empty
result; copies of a row get the same verdict. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as, stage
from storelens.llm.textbytes import (
    CONTINUATION,
    RangeHash,
    batch_slices,
    counts_of,
    find_words,
    mix,
    window_hashes,
)

SYMBOLS = "#*$%&|<>"
WINDOW = 5

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_IS_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_IS_LOWER = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))
#: First bytes of characters beyond ASCII count as letters.
_IS_LETTER = _IS_UPPER | _IS_LOWER | (np.arange(256) >= 0xC0)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letters", "n_upper", "n_lower", "n_loud_words", "n_stop_words", "n_marked_words",
)


def _per_row(row: np.ndarray, mask: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row[mask], minlength=rows).astype(np.int64)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:]] = same
    often = later.copy()
    often[order[:-1]] |= same
    return often, later


def count_text(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """The counts of each row, in the order of COUNTS."""
    rows = len(offsets) - 1
    words = find_words(offsets, data)
    ranges = RangeHash(data)
    hashes = ranges(words.starts, words.ends)
    n_words = np.diff(words.first)
    salt = mix(np.arange(rows, dtype=np.uint64) + np.uint64(0xABCDEF))

    starts = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(CONTINUATION[data], out=starts[1:])
    chars = words.ends - words.starts - (starts[words.ends] - starts[words.starts])
    word_chars = np.bincount(words.row, weights=chars, minlength=rows).astype(np.int64)

    # lines: cut at \n and at the borders of rows
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.minimum(np.concatenate([line_starts[1:], [len(data)]]), offsets[np.minimum(line_row + 1, rows)])
    ended = np.isin(line_ends - 1, breaks) & (line_ends > line_starts)
    line_ends = line_ends - ended
    full = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, line_row = line_starts[full], line_ends[full], line_row[full]
    _, later = _repeated(ranges(line_starts, line_ends) ^ salt[line_row])

    # words inside windows that occur twice or more in their text
    runs = window_hashes(hashes, WINDOW)
    whole = words.row[: len(runs)] == words.row[WINDOW - 1 :][: len(runs)]
    places = np.flatnonzero(whole)
    often, _ = _repeated(runs[places] ^ salt[words.row[places]])
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, places[often], 1)
    np.add.at(edge, places[often] + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0

    last = data[words.ends - 1] if len(words.ends) else data[:0]
    return [
        n_words,
        word_chars,
        counts_of(_IS_SYMBOL[data], offsets),
        np.bincount(line_row, minlength=rows).astype(np.int64),
        _per_row(line_row, later, rows),
        _per_row(words.row, covered, rows),
        counts_of(_IS_LETTER[data], offsets),
        counts_of(_IS_UPPER[data], offsets),
        counts_of(_IS_LOWER[data], offsets),
        _per_row(words.row, last == ord("!"), rows),
        _per_row(words.row, last == ord("."), rows),
        _per_row(words.row, _IS_SYMBOL[last], rows),
    ]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for kept, offsets, data in batch_slices(batches, "text", ["doc_id"]):
        columns = [pa.array(c, pa.int64()) for c in count_text(offsets, data)]
        yield pa.RecordBatch.from_arrays([kept.column(0), *columns], names=["doc_id", *COUNTS])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(2)


def rules() -> dict[str, Column]:
    """Votes by rule: 0 bad, 1 good, 2 abstains."""
    n, letters = F.col("n_words"), F.col("n_upper") + F.col("n_lower")
    return {
        "symbols": _vote(20 * F.col("n_symbols") <= n, 4 * F.col("n_symbols") > n),
        "capitals": _vote(5 * F.col("n_upper") <= letters, 2 * F.col("n_upper") > letters),
        "loud": _vote(20 * F.col("n_loud_words") <= n, 4 * F.col("n_loud_words") > n),
        "marked": _vote(20 * F.col("n_marked_words") <= n, 5 * F.col("n_marked_words") > n),
        "letters": _vote(
            100 * F.col("n_letters") >= 92 * F.col("word_chars"), 100 * F.col("n_letters") < 86 * F.col("word_chars")
        ),
        "lines": _vote(F.col("n_dup_lines") == 0, 4 * F.col("n_dup_lines") > F.col("n_lines")),
        "length": _vote(n >= 30, n < 10),
        "stops": _vote(100 * F.col("n_stop_words") >= 2 * n, (F.col("n_stop_words") == 0) & (n >= 20)),
        "word_length": _vote(
            F.col("word_chars").between(3 * n, 10 * n), (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)
        ),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> np.ndarray:
    """Posterior probability of the good class for each vote pattern (rules in
    columns). Starts from the majority and adds one imagined vote of each kind."""
    balance = (patterns == 1).sum(1) - (patterns == 0).sum(1)
    posterior = np.where(balance > 0, 0.9, np.where(balance < 0, 0.1, 0.5))
    for _ in range(steps):
        weights = np.stack([(1 - posterior) * counts, posterior * counts])
        scores = np.log(weights.sum(1) + 1)[:, None].repeat(len(patterns), 1)
        for rule in range(patterns.shape[1]):
            table = np.stack([np.bincount(patterns[:, rule], w, 3) for w in weights]) + 1.0
            share = np.log(table / table.sum(1, keepdims=True))
            scores += share[:, patterns[:, rule]]
        updated = 1 / (1 + np.exp(np.clip(scores[0] - scores[1], -500, 500)))
        done = np.abs(updated - posterior).max(initial=0) < 1e-9
        posterior = updated
        if done:
            break
    return posterior


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The counts of every row, ``base_failed``, the posterior ``good`` and ``kept``."""
    spark = prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]
    counted = docs.mapInArrow(_count, f"doc_id {ids}, " + ", ".join(f"{c} long" for c in COUNTS))
    votes = rules()
    code = sum((vote * 3**i for i, vote in enumerate(votes.values())), F.lit(0))
    counted = stage(counted.withColumn("pattern", code.cast("int")), "quality-counts")
    n = F.col("n_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    # at most 3^9 patterns, however many documents there are
    passed = F.count_if(~failed).alias("count")
    seen = counted.groupBy("pattern").agg(passed).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in seen], dtype=np.int64)
    digits = codes[:, None] // 3 ** np.arange(len(votes)) % 3
    posterior = estimate(digits, np.array([r["count"] for r in seen], dtype=float))
    rows = [(int(c), float(p)) for c, p in zip(codes, posterior)]
    verdicts = spark.createDataFrame(rows, "pattern int, good double")
    return counted.join(F.broadcast(verdicts), "pattern").select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        "good",
        (~failed & (F.col("good") >= threshold)).alias("kept"),
    )
