"""Secrets found by fixed rules and by a character convolutional network.

The rules give three kinds of spans (assign, access, hex). Every token of 16
characters or more with letters is a candidate, whether rules touch it or not, but
for those of letters of one case and marks below 24, which are words. The network
reads all of a candidate with its surroundings: a window slides over the token, and
the highest score of its places counts. It is trained here, in numpy, on labelled
findings: what the rules find in a bounded sample of documents, with its name
taken away half of the time, keys generated in other shapes, and as the other
class the candidates that no rule finds and generated addresses, links, versions,
numbers, long words and identifiers of programs. Its scores are calibrated on findings it was not trained on, and its
threshold is the highest one that keeps the demanded recall there, on those that
no rule catches. Candidates above it are added whole as spans of kind ``model``
unless rules cover every character of them; spans of the rules always stay.

Nulls and empty texts have no spans. One row comes out per row, copies and null
ids included; extra columns are ignored. Without training rows the generated
examples are the training data.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as

# The rules' fixed patterns.
ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "model")
_NAMES = ("passw", "secret", "token", "api")

#: Any long run of the characters secrets consist of.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
WORD, WORD_CHARS = re.compile(r"[a-z+/_.=-]*|[A-Z+/_.=-]*"), 24
BEFORE, LENGTH = 24, 72
#: The window moves on by so much, and to so far behind the candidate.
STEP, AFTER = 24, 24
#: Bounds of the training sample.
SAMPLE_DOCUMENTS, SAMPLE_EACH = 4000, 1500
RECALL = 0.98

_CHARS = "".join(map(chr, range(32, 127)))
#: One class for each visible ASCII character, line ends, padding, and the rest.
_CLASS = np.full(0x110000, len(_CHARS) + 2, dtype=np.uint8)
_CLASS[[ord(c) for c in _CHARS]] = np.arange(1, len(_CHARS) + 1)
_CLASS[[9, 10, 13]] = len(_CHARS) + 1
CLASSES = len(_CHARS) + 3


def rule_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the rules' matches, leftmost and without overlap
    within a kind."""
    spans = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        spans += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    for run in CANDIDATE.finditer(text):
        # a hexadecimal run of the least length lies inside such a run
        for m in HEX.finditer(text, run.start(), run.end()):
            if m.end() - m.start() >= LEAST["hex"]:
                spans.append((m.start(), "hex", m.end()))
    return spans


def candidates(text: str) -> list[tuple[int, int]]:
    """Long runs with letters that are no words."""
    found = []
    for m in CANDIDATE.finditer(text):
        value = m[0]
        word = len(value) < WORD_CHARS and WORD.fullmatch(value)
        if not word and any(c.isalpha() for c in value):
            found.append(m.span())
    return found


def window(text: str, start: int, blank: int = 0) -> np.ndarray:
    """Character classes of a place in a candidate and of what surrounds it; with
    spaces for what lies before ``blank``."""
    low = max(0, start - BEFORE)
    part = text[low : start - BEFORE + LENGTH]
    if blank > low:
        part = " " * min(blank - low, len(part)) + part[blank - low :]
    codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(LENGTH, dtype=np.uint8)
    shift = max(0, BEFORE - start)
    out[shift : shift + len(codes)] = _CLASS[codes]
    return out


def places(start: int, end: int) -> range:
    """Where windows begin that together hold a candidate and its surroundings."""
    more = max(0, end + AFTER - (start + LENGTH - BEFORE))
    return range(start, start + STEP * -(-more // STEP) + 1, STEP)


def united(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def covered(start: int, end: int, stretches: tuple[list[int], list[int]]) -> bool:
    """Whether the stretches leave no character of a range out."""
    at = bisect_right(stretches[0], start) - 1
    return at >= 0 and end <= stretches[1][at]


def overlapping(
    ranges: list[tuple[int, int]], spans: list[tuple[int, int]]
) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Each range, in order, with the spans that touch it; one pass over both."""
    left = sorted(spans, reverse=True)
    near: list[tuple[int, int]] = []
    for start, end in ranges:
        near = [span for span in near if span[1] > start]
        while left and left[-1][0] < end:
            span = left.pop()
            if span[1] > start:
                near.append(span)
        yield start, end, list(near)


@dataclass
class Network:
    """Embedding by character, one convolution, maximum and mean over places."""

    kernel: np.ndarray  # width x class x filter
    bias: np.ndarray
    weights: np.ndarray  # of maxima, then means
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    recall: float = float("nan")  # at the threshold, on held-out findings

    def _forward(self, x: np.ndarray):
        width = len(self.kernel)
        n = x.shape[1] - width + 1
        conv = sum(self.kernel[k][x[:, k : k + n]] for k in range(width)) + self.bias
        active = np.maximum(conv, 0)
        pooled = np.concatenate([active.max(1), active.mean(1)], axis=1)
        return active, pooled, pooled @ self.weights + self.offset

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of being a secret."""
        out = [self._forward(x[i : i + 512])[2] for i in range(0, len(x), 512)]
        logits = np.concatenate([*out, np.zeros(0)])
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -60, 60)))


def fit(
    x: np.ndarray, y: np.ndarray, own: np.ndarray, filters: int = 16, width: int = 5, epochs: int = 8, seed: int = 5
) -> Network:
    """Trains on three quarters of the findings, calibrates on the others. ``own``
    marks the secrets that no rule catches; the threshold keeps RECALL of them."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, order = order[: len(x) // 4], order[len(x) // 4 :]
    net = Network(
        rng.normal(0, 0.2, (width, CLASSES, filters)), np.zeros(filters), rng.normal(0, 0.2, 2 * filters), 0.0
    )
    names = ("kernel", "bias", "weights", "offset")
    moments = {n: [np.zeros_like(np.asarray(getattr(net, n), dtype=float)) for _ in range(2)] for n in names}
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(order), max(1, len(order) // 64)):
            xb, yb = x[batch], y[batch]
            active, pooled, logits = net._forward(xb)
            error = (1 / (1 + np.exp(-logits)) - yb) / len(batch)
            back = np.outer(error, net.weights)
            grad = np.zeros_like(active)
            top = active.argmax(1)
            rows, cols = np.indices(top.shape)
            grad[rows, top, cols] += back[:, :filters]
            grad += back[:, None, filters:] / active.shape[1]
            grad *= active > 0
            kernel = np.zeros_like(net.kernel)
            for k in range(width):
                np.add.at(kernel[k], xb[:, k : k + active.shape[1]], grad)
            grads = {"kernel": kernel, "bias": grad.sum((0, 1)), "weights": pooled.T @ error, "offset": error.sum()}
            step += 1
            for name in names:
                m, v = moments[name]
                g = grads[name] + 1e-4 * np.asarray(getattr(net, name))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                change = 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - change)
    logits, truth = net._forward(x[held])[2], y[held]
    for _ in range(200):  # Platt scaling, with the targets drawn in a little
        p = 1 / (1 + np.exp(-np.clip(net.scale * logits + net.shift, -60, 60)))
        miss = p - np.where(truth == 1, 0.99, 0.01)
        net.scale -= 0.1 * float((miss * logits).mean())
        net.shift -= 0.1 * float(miss.mean())
    scores = np.sort(net.score(x[held][own[held]]))
    if len(scores):
        net.threshold = float(scores[int((1 - RECALL) * len(scores))])
        net.recall = float((scores >= net.threshold).mean())
    return net


def generated(n: int, seed: int = 3) -> tuple[list[tuple[str, int]], list[int]]:
    """Labelled findings of shapes the sample may lack, in invented surroundings."""
    rng = np.random.default_rng(seed)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", _CHARS[16:26] + _CHARS[33:59] + _CHARS[65:91]]
    words = "the of und les para on value see at for key id with page and ref".split()

    def some(chars: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(chars), rng.integers(low, high)))

    def name() -> str:
        return some("abcdefghijklmnopqrstuvwxyz", 2, 9)

    made, labels = [], []
    for i in range(n):
        if i % 2:
            value = str(rng.choice(["", "", "sk_", "key-", "gh_", "AKIA"])) + some(alphabets[rng.integers(3)], 20, 44)
            lead = str(rng.choice(["", "", 'token = "', "secret: ", "key=", "Bearer "]))
        else:
            lead = ""
            number = str(rng.integers(10, 99999))
            shapes = [
                f"{name()}.{name()}.{number}.{name()}-{name()}.example.org",
                f"{name()}/{name()}/{rng.integers(1990, 2030)}/{name()}-{name()}-{number}.html",
                f"2024-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}.{rng.integers(10, 60)}-{name()}",
                f"{name()}_{name()}_{name()}_{number}_{name()}",
                f"{name()}-{number}.{rng.integers(1, 30)}.{rng.integers(1, 9)}.{name()}.{name()}.tar.gz",
                f"{number}.{number}.{number}.{number}/{name()}" + "=" * int(rng.integers(0, 8)),
                f"{name()}{name()}{name()}{name()}{number}",
            ]
            value = shapes[rng.integers(len(shapes))]
        before = " ".join(rng.choice(words, 4)) + " " + lead
        made.append((f"{before}{value}{rng.choice([' ', '. ', chr(10), chr(34) + ' '])}{' '.join(rng.choice(words, 6))}", len(before)))
        labels.append(i % 2)
    return made, labels


def generated_inside(n: int, seed: int = 4) -> tuple[list[tuple[str, int]], list[int]]:
    """Labelled places in long links and paths, with a key in them and without."""
    rng = np.random.default_rng(seed)
    letters, digits = list("abcdefghijklmnopqrstuvwxyz"), list("0123456789")
    keys = list(_CHARS[16:26] + _CHARS[33:59] + _CHARS[65:91])

    def part() -> str:
        kind = rng.integers(6)
        if kind == 0:
            return str(rng.integers(1, 2030))
        name = "".join(rng.choice(letters, rng.integers(3, 11)))
        if kind == 1:
            return name + str(rng.choice(["-", "_", "."])) + "".join(rng.choice(letters, rng.integers(2, 9)))
        return name + ("".join(rng.choice(digits, rng.integers(1, 4))) if kind == 2 else "")

    def path(low: int, high: int) -> str:
        return "/".join(part() for _ in range(rng.integers(low, high)))

    made, labels = [], []
    for i in range(n):
        before = part() + str(rng.choice([" ", " see ", ": https:", "\n", ' "', " file:"]))
        lead = "//" + path(2, 9) + "/"
        key = "".join(rng.choice(keys, rng.integers(20, 45))) if i % 2 else part()
        tail = str(rng.choice(["", "", ".html", "/" + path(1, 6), "=" + part()]))
        text = before + lead + key + tail + str(rng.choice([" ", ". ", "\n", '" '])) + part() + " " + part()
        at, end = len(before), len(before + lead + key)
        found = [p for p in places(at, len(before + lead + key + tail))]
        if i % 2:  # places whose window holds enough of the key
            found = [p for p in found if min(end, p + LENGTH - BEFORE) - max(end - len(key), p - BEFORE) >= 20]
        made.append((text, int(rng.choice(found))))
        labels.append(i % 2)
    return made, labels


# What generated identifiers and words are made of.
_PARTS = (
    "get set http response version user name list map load save read write file path data base client server request "
    "handler error value index count total parse build make create update delete find search sort filter merge split "
    "join table column row key token cache queue node tree graph point line color size first last next open close send "
    "connect process thread job event state config option util helper manager factory service provider controller model "
    "view test case suite"
).split()
_SYLLABLES = (
    "ba be ce co da de en er es fi ga ge he in is ja ko la li lo ma me mi na ne no on or pa pe qu ra re ri ro sa se si so "
    "sta str ta te th ti to tra tri un ur va ve vi wa we wi za ch sch ung tion ment able ing ed ly ness est ism ous ive"
).split()


def generated_names(n: int, seed: int = 5) -> tuple[list[tuple[str, int]], list[int]]:
    """Labelled keys without digits or of few characters, and identifiers, paths and
    long words with and without numbers."""
    rng = np.random.default_rng(seed)
    lower, mixed = list(_CHARS[65:91]), list(_CHARS[33:59] + _CHARS[65:91])
    words = "the of und les para on value see at for key id with page and ref return new class import def".split()

    def part() -> str:
        if rng.random() < 0.5:
            return str(rng.choice(_PARTS))
        return "".join(rng.choice(_SYLLABLES, int(rng.integers(2, 4))))

    def key() -> str:
        kind, size = rng.integers(9), int(rng.integers(24, 45))
        if kind < 6:
            value = "".join(rng.choice(mixed if kind < 3 else lower, size))
            return value.upper() if kind == 5 else value
        return "".join(rng.choice(mixed + list("0123456789"), int(rng.integers(16, 26))))

    def name() -> str:
        parts = [part() for _ in range(int(rng.integers(3, 7)))]
        number = str(rng.integers(0, 1000)) if rng.random() < 0.5 else ""
        kind = int(rng.integers(9))
        if kind < 3:
            value = "".join(p.capitalize() for p in parts) + number
            value = value[0].lower() + value[1:] if rng.random() < 0.5 else value
        elif kind < 8:
            value = ("_", "-", ".", "_", "")[kind - 3].join(parts) + number
            value = value.upper() if kind == 6 else value
        else:
            parts = [p.capitalize() if rng.random() < 0.3 else p for p in parts]
            value = "/".join(parts) + str(rng.choice(["", "", ".py", ".html", ".java", ".md"]))
        while len(value) < 16:
            value += part()
        return value

    made, labels = [], []
    for i in range(n):
        lead = str(rng.choice(["", "", "= ", "(", '"', ": ", "'"]))
        before = " ".join(rng.choice(words, 4)) + " " + lead
        tail = str(rng.choice([" ", ". ", "\n", '" ', "()", "; ", ", "]))
        made.append((before + (key() if i % 2 else name()) + tail + " ".join(rng.choice(words, 6)), len(before)))
        labels.append(i % 2)
    return made, labels


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of candidates with the rules' verdict."""
    for batch in batches:
        windows, labels = [], []
        for text in batch.column(0).to_pylist():
            spans = [(a, b) for a, _, b in rule_spans(text)]
            for start, end, hits in overlapping(candidates(text), spans):
                for at in places(start, end):
                    low, high = max(start, at - BEFORE), min(end, at + LENGTH - BEFORE)
                    seen = [min(b, high) - max(a, low) >= min(20, b - max(a, start)) for a, b in hits]
                    if hits and not any(seen):
                        continue  # the rest of a token that a rule touches may be either
                    # without its name as well, so that the value alone is learnt
                    for own in {window(text, at).tobytes(), window(text, at, start if hits else 0).tobytes()}:
                        windows.append(own)
                        labels.append(int(bool(hits)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(windows, pa.binary()), pa.array(labels, pa.int32())], names=["window", "label"]
        )


def train(docs: DataFrame, text_col: str = "text") -> Network:
    """The network for a table: from findings in SAMPLE_DOCUMENTS of its texts at
    most, SAMPLE_EACH of each class at most, and four times as many generated ones."""
    texts = rows_as(docs, text=text_col).where("text is not null")
    found = _sample(texts).mapInArrow(_findings, "window binary, label int").distinct()
    rows = []
    for label in (0, 1):
        one = found.where(F.col("label") == label).orderBy(F.xxhash64("window"), "window").limit(SAMPLE_EACH)
        rows += one.collect()
    generators = ((generated, 2), (generated_inside, 2), (generated_names, 4))
    made, labels = (sum(own, []) for own in zip(*[make(n * SAMPLE_EACH) for make, n in generators]))
    x = [np.frombuffer(r["window"], np.uint8) for r in rows] + [window(t, at) for t, at in made]
    y = [r["label"] for r in rows] + labels
    own = [False] * len(rows) + [bool(label) and not rule_spans(t) for (t, _), label in zip(made, labels)]
    return fit(np.stack(x), np.array(y, dtype=float), np.array(own))


def _sample(texts: DataFrame) -> DataFrame:
    """About SAMPLE_DOCUMENTS texts by their hash, the same on every run."""
    total = texts.count()
    share = max(total // SAMPLE_DOCUMENTS, 1)
    return texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)


def all_spans(net: Network, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind number, end) of each text, sorted."""
    spans = [[(s, KINDS.index(k), e) for s, k, e in rule_spans(t)] for t in texts]
    where, windows = [], []
    for i, text in enumerate(texts):
        for start, end in candidates(text):
            where.append((i, start, end, len(windows)))
            windows += [window(text, at) for at in places(start, end)]
    if windows:
        best = np.maximum.reduceat(net.score(np.stack(windows)), [first for *_, first in where])
        rules = [united([(s, e) for s, _, e in own]) for own in spans]
        for (i, start, end, _), score in zip(where, best):
            if score >= net.threshold and not covered(start, end, rules[i]):
                spans[i].append((start, KINDS.index("model"), end))
    return [sorted(own) for own in spans]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_model, base_spans, spans) of every row."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(net, [t or "" for t in batch.column(1).to_pylist()])
            counts = [[sum(k == kind for _, k, _ in own) for own in found] for kind in range(4)]
            base = [_joined([s for s in own if s[1] < 3]) for own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                    pa.array([_joined(own) for own in found]),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans"],
            )

    kinds = "n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string"
    return docs.mapInArrow(run, f"doc_id {ids}, {kinds}")


def redact(docs: DataFrame, net: Network, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of the text replaced by a mark."""
    prepared(docs.sparkSession)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts = batch.column(place).to_pylist()
            found = all_spans(net, [t or "" for t in texts])
            cleaned = [t if t is None else clean(t, own) for t, own in zip(texts, found)]
            columns = list(batch.columns)
            columns[place] = pa.array(cleaned, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
