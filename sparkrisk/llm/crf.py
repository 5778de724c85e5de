"""Document quality from a linear-chain conditional random field over lines (operator 9).

Every line has features of its own (character classes, lengths, repetition) and those of the
lines before and after it. A two-label chain (good, bad) is trained on documents whose lines
all carry the document's label. Scoring runs forward-backward over each whole document; the
document's quality is the length-weighted mean of its lines' marginals, put through a
calibration fitted on the same documents.

Labels: two labels make the recursions scalar. With unary log-odds ``u`` and transition scores
``A``, the forward log-odds are ``f[t] = u[t] + g(f[t-1])``, the backward ones
``b[t] = h(u[t+1] + b[t+1])``, and the marginal of line ``t`` is ``sigmoid(f[t] + b[t])``. The
documents of a batch advance together in numpy.

The model is fitted on the driver from the features of at most ``SAMPLE_DOCS`` labelled
documents (those with the smallest hash of their id); scoring covers every document.

Defined results: a null or empty text is one empty line and gets a score as any other; null ids
keep a null id; rows of ``labels`` with a null or other label are not used; several labels of
one document count as the largest. Without two classes of labels the score is the share of
label 1, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.wordhash import mix, utf8
from sparkrisk.llm.wordhash import words as word_hashes

# Labelled documents used for fitting, at most: the only sample, its bound does not grow.
SAMPLE_DOCS = 4000

_CLASSES = {  # byte classes whose shares are line features
    "symbols": b"#*$%&<>@^~_=+\\/{}[]",
    "bars": b"|",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digits": b"0123456789",
    "marks": b"!?",
    "stops": b".,;:",
    "space": b" \t\r\x0b\x0c",
    "wide": bytes(range(0xC0, 0x100)),
}
_LUTS = np.zeros((len(_CLASSES), 256), dtype=np.uint8)
for _i, _chars in enumerate(_CLASSES.values()):
    _LUTS[_i, list(_chars)] = 1
OWN = len(_CLASSES) + 7
FEATURES = 3 * OWN + 3


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, lines per text) of texts given as UTF-8 ``data`` and ``offsets``."""
    n = len(offsets) - 1
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    newline = np.nonzero(data == 10)[0]
    text_of = np.searchsorted(offsets, newline, side="right") - 1
    lines = np.bincount(text_of, minlength=n)[:n] + 1
    # Start and end of every line: ends are the newlines and the text ends, in order.
    ends = np.empty(len(newline) + n, dtype=np.int64)
    last = np.cumsum(lines) - 1
    inner = np.ones(len(ends), dtype=bool)
    inner[last] = False
    ends[inner], ends[last] = newline, offsets[1:]
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    starts[last[:-1] + 1] = offsets[1:-1]
    starts[0] = 0
    length = ends - starts
    x = np.zeros((len(ends), OWN), dtype=np.float32)
    size, c = np.maximum(length, 1), len(_CLASSES)
    full = np.nonzero(length)[0]
    if len(full):
        bounds = np.stack([starts[full], ends[full]], 1).ravel()
        padded = np.append(data, np.uint8(10))
        for i in range(len(_CLASSES)):
            x[full, i] = np.add.reduceat(_LUTS[i][padded], bounds, dtype=np.int64)[::2] / size[full]
        hashes, first, _, _ = word_hashes(data, offsets, lower=True)
        line = np.searchsorted(starts, first, side="right") - 1
        if len(first):
            code = hashes >> np.uint64(28)
            words = np.bincount(line, minlength=len(ends))
            distinct = np.unique(line.astype(np.uint64) << np.uint64(36) | code) >> np.uint64(36)
            unique = np.bincount(distinct.astype(np.int64), minlength=len(ends))
            again = np.zeros(len(ends))
            same = np.nonzero((code[1:] == code[:-1]) & (line[1:] == line[:-1]))[0]
            np.add.at(again, line[same], 1)
            some = np.maximum(words, 1)
            x[:, c] = np.minimum(length / some, 40) / 10
            x[:, c + 1] = (words - unique) / some
            x[:, c + 2] = again / some
            x[:, c + 3] = np.log1p(words) / 5
            # Lines with an equal line in the same text: equal sums of word hashes and length.
            key = mix(np.bincount(line, weights=(code >> np.uint64(8)).astype(np.float64), minlength=len(ends)).astype(np.uint64)
                      + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + np.repeat(np.arange(n, dtype=np.uint64), lines) * np.uint64(0xC2B2AE3D27D4EB4F))
            _, at, count = np.unique(key, return_inverse=True, return_counts=True)
            x[:, c + 4] = ((count[at] > 1) & (length > 0)).astype(np.float32)
    x[:, c + 5] = np.log1p(length) / 8
    x[:, c + 6] = np.repeat(np.log1p(lines), lines) / 5
    out = np.zeros((len(ends), FEATURES), dtype=np.float32)
    out[:, :OWN] = x
    begin = np.ones(len(ends), dtype=bool)
    begin[1:] = False
    begin[np.cumsum(lines)[:-1]] = True
    end = np.zeros(len(ends), dtype=bool)
    end[last] = True
    out[1:, OWN : 2 * OWN] = np.where(begin[1:, None], 0, x[:-1])
    out[:-1, 2 * OWN : 3 * OWN] = np.where(end[:-1, None], 0, x[1:])
    out[:, 3 * OWN] = 1
    out[:, 3 * OWN + 1] = begin
    out[:, 3 * OWN + 2] = end
    return out, length, lines


@dataclass
class ChainModel:
    weights: np.ndarray  # unary log-odds of good
    scores: np.ndarray  # 2 x 2 transition scores, [from, to], 1 is good
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def forward_backward(self, unary: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward log-odds, backward log-odds, marginals of good) for all lines."""
        a = self.scores
        first = np.cumsum(lines) - lines
        order = np.argsort(-lines, kind="stable")
        ranked, sizes = first[order], lines[order]
        longest = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with more than t lines
        f, b = unary.copy(), np.zeros_like(unary)
        for t in range(1, longest):
            at = ranked[: alive[t]] + t
            prev = f[at - 1]
            f[at] += np.logaddexp(a[1, 1] + prev, a[0, 1]) - np.logaddexp(a[1, 0] + prev, a[0, 0])
        for t in range(longest - 1, 0, -1):
            at = ranked[: alive[t]] + t
            nxt = unary[at] + b[at]
            b[at - 1] = np.logaddexp(a[1, 1] + nxt, a[1, 0]) - np.logaddexp(a[0, 1] + nxt, a[0, 0])
        return f, b, 1 / (1 + np.exp(-np.clip(f + b, -60, 60)))

    def quality(self, features: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each text."""
        if not len(lines):
            return np.zeros(0)
        p = self.forward_backward(features @ self.weights, lines)[2]
        first = np.cumsum(lines) - lines
        weight = length + 1.0
        return np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)

    def score(self, features: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(lines), self.constant)
        m = np.clip(self.quality(features, length, lines), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(m / (1 - m)) + self.shift)))


def fit_chain(features: np.ndarray, length: np.ndarray, lines: np.ndarray, label: np.ndarray,
              steps: int = 250, rate: float = 0.05, l2: float = 1e-3, stay_l2: float = 0.02) -> ChainModel:
    """Maximum likelihood (with a ridge) by Adam over all lines, then the calibration."""
    if len(label) == 0 or label.min() == label.max():
        return ChainModel(np.zeros(features.shape[1]), np.zeros((2, 2)), constant=float(label.mean()) if len(label) else 0.5)
    x = features.astype(np.float64)
    y = np.repeat(label, lines).astype(np.float64)
    share = np.repeat(1.0 / lines, lines)  # every document counts alike, long or short
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(lines) - lines] = False
    to = np.nonzero(inner)[0]
    theta = np.zeros(x.shape[1] + 4)
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    docs = float(len(lines))
    for step in range(1, steps + 1):
        chain = ChainModel(theta[:-4], theta[-4:].reshape(2, 2))
        unary = x @ chain.weights
        f, b, p = chain.forward_backward(unary, lines)
        grad = np.empty_like(theta)
        grad[:-4] = x.T @ ((y - p) * share) / docs - l2 * chain.weights
        # Pair marginals of neighbouring lines from both log-odds.
        left, right = f[to - 1], unary[to] + b[to]
        joint = np.stack([chain.scores[i, j] + i * left + j * right for i in (0, 1) for j in (0, 1)], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        seen = np.stack([(y[to - 1] == i) & (y[to] == j) for i in (0, 1) for j in (0, 1)], 1)
        grad[-4:] = ((seen - joint) * share[to, None]).sum(0) / docs - stay_l2 * theta[-4:]
        mean = 0.9 * mean + 0.1 * grad
        var = 0.999 * var + 0.001 * grad * grad
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.999**step)) + 1e-9)
    chain = ChainModel(theta[:-4].copy(), theta[-4:].reshape(2, 2).copy())
    m = np.clip(chain.quality(x, length, lines), 1e-6, 1 - 1e-6)
    z = np.stack([np.log(m / (1 - m)), np.ones(len(m))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps of a two-parameter logistic fit
        p = 1 / (1 + np.exp(-z @ w))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, z.T @ (label - p) - 1e-3 * (w - [1.0, 0.0]))
    chain.slope, chain.shift = max(float(w[0]), 1e-3), float(w[1])
    return chain


def held_out(key: str):
    """Rows kept out of training: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample_docs: int = SAMPLE_DOCS) -> ChainModel:
    """The model from the labelled documents that are not held out."""
    import pyarrow as pa

    known = labels.select(labels[key].alias("k"), labels[label].alias("y")).filter(
        F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out("k"))
    known = known.groupBy("k").agg(F.max("y").cast("int").alias("y"))
    picked = known.orderBy(F.xxhash64("k"), "k").limit(sample_docs)
    rows = docs.select(docs[key].alias("k"), docs[text].alias("t")).join(F.broadcast(picked), "k").select("k", "y", "t")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, length, lines = line_features(*utf8(batch.column(2)))
            cut = np.cumsum(lines)[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.tobytes() for a in np.split(x, cut)], pa.binary()),
                 pa.array([a.astype(np.int64).tobytes() for a in np.split(length, cut)], pa.binary())], names=["k", "y", "x", "n"])

    kind = docs.schema[key].dataType.simpleString()
    got = rows.mapInArrow(run, f"k {kind}, y int, x binary, n binary").collect()
    got.sort(key=lambda r: (r["k"], r["n"], r["x"]))  # the fit does not depend on the order of arrival
    if not got:
        return ChainModel(np.zeros(FEATURES), np.zeros((2, 2)), constant=0.5)
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in got])
    length = np.concatenate([np.frombuffer(r["n"], np.int64) for r in got])
    lines = np.array([len(r["n"]) // 8 for r in got])
    return fit_chain(x, length, lines, np.array([r["y"] for r in got], dtype=np.float64))


def score(docs: DataFrame, model: ChainModel, text: str = "text", out: str = "score") -> DataFrame:
    """All columns and the quality of every whole text, 0 to 1. Narrow: no shuffle."""
    import pyarrow as pa
    from pyspark.sql import types as T

    fields = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.DoubleType())])
    at = [f.name for f in fields].index(text)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            s = model.score(*line_features(*utf8(batch.column(at)))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[f.name for f in schema.fields])

    return docs.select(*[docs[f.name] for f in fields]).mapInArrow(run, schema)
