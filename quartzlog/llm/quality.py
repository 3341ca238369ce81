"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

Features of a text are n-grams over two word streams: the words themselves (orders 1-2, A-Z lower-cased) and their
shapes (orders 1-3): letter case, digits, punctuation, and whether a word repeats the one before it. Each n-gram is
hashed to one of 2**BITS weights; its value is its share of the stream's n-grams. A score is the logistic function of
the sparse dot product, so the model is a weight table of fixed size whatever the corpus.

The model is fitted on at most `bound` labelled rows (TRAIN_ROWS by default, those of lowest hashed id), one FTRL-proximal
update per row. Every document is scored over its whole text.

Cases: a null text counts as empty and scores by the bias alone; rows with null id or label do not train; without any
training rows all scores are 0.5; repeated rows are scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import LOWER, crc_mod, mix, pick, raw, slices, span_hashes, training_sample, word_spans

BITS = 20
TRAIN_ROWS = 8000
SCALE = 4.0
SLICE = 2 << 20


def _counts(body: np.ndarray, table: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(body) + 1, np.int32)
    np.cumsum(table[body], out=total[1:])
    return total[end] - total[begin]


_CLASS = {"upper": np.zeros(256, bool), "lower": np.zeros(256, bool), "digit": np.zeros(256, bool), "high": np.zeros(256, bool)}
_CLASS["upper"][65:91] = _CLASS["lower"][97:123] = _CLASS["digit"][48:58] = _CLASS["high"][128:] = True


def features(body: np.ndarray, at: np.ndarray, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the five n-gram orders: weight indices in text order, and the n + 1 offsets of the texts' runs."""
    n = len(at) - 1
    if not len(body):
        return [(np.empty(0, np.int64), np.zeros(n + 1, np.int64))] * 5
    begin, end = word_spans(body, at)
    folded = LOWER[body]
    size = end - begin
    word = span_hashes(folded, begin, end)
    first = np.searchsorted(begin, at)
    same = np.zeros(len(word), bool)
    same[1:] = word[1:] == word[:-1]
    same[first[:-1][first[:-1] < len(word)]] = False
    upper, lower, digit, high = (_counts(body, _CLASS[k], begin, end) for k in ("upper", "lower", "digit", "high"))
    level = lambda x: np.minimum(x, 2) + (x == size)
    shape = level(upper)
    for x in (np.minimum(lower, 1) + (lower == size), np.minimum(digit, 1) + (digit == size), np.minimum(size - upper - lower - digit - high, 3), same.astype(np.int64)):
        shape = shape * 4 + x
    out, mask = [], np.uint64((1 << bits) - 1)
    with np.errstate(over="ignore"):
        for stream, orders, salt in ((word, 2, 1), (mix(shape.astype(np.uint64) + np.uint64(99)), 3, 11)):
            gram = stream
            for order in range(1, orders + 1):
                if order > 1:
                    gram = mix(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + stream[order - 1 :]) if len(gram) else gram
                    # grams that cross into the next text go
                begins = np.minimum(first, len(stream))
                counts = np.maximum(np.diff(begins) - (order - 1), 0)
                ends = np.cumsum(counts)
                keep = np.repeat(begins[:-1] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
                out.append(((mix(gram[keep] + np.uint64(salt + order)) & mask).astype(np.int64), np.concatenate([[0], ends])))
    return out


class Ftrl:
    """FTRL-proximal logistic regression with per-coordinate rates."""

    def __init__(self, bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last one is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(z.shape, self.l1)
        if isinstance(at, slice) or len(at) and at[-1] == len(self.z) - 1:
            l1[-1] = 0
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, y: int, weight: float = 1.0) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x * weight
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, epochs: int = 3) -> np.ndarray:
    """Weights and bias from (label, indices, values) rows; the rarer label's gradients weigh more, up to fourfold."""
    model, bias = Ftrl(bits), 1 << bits
    n1 = sum(y for y, _, _ in rows)
    rare = {1: min(4.0, max(1.0, (len(rows) - n1) / max(1, n1))), 0: min(4.0, max(1.0, n1 / max(1, len(rows) - n1)))}
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            y, at, x = rows[k]
            model.update(np.append(at, bias), np.append(x, 1.0), y, rare[y])
    return model.weights().astype(np.float32)


def sparse_row(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices of text k with their summed values."""
    at, x = [], []
    for index, ends in parts:
        own = index[ends[k] : ends[k + 1]]
        at.append(own)
        x.append(np.full(len(own), SCALE / max(1, len(own))))
    index, where = np.unique(np.concatenate(at), return_inverse=True)
    return index, np.bincount(where, np.concatenate(x), len(index)) if len(index) else np.empty(0)


def score(body: np.ndarray, at: np.ndarray, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    total = np.full(len(at) - 1, float(weights[-1]))
    for index, ends in features(body, at, bits):
        sums = np.concatenate([[0.0], np.cumsum(weights[index], dtype=np.float64)])
        total += (sums[ends[1:]] - sums[ends[:-1]]) * SCALE / np.maximum(1, np.diff(ends))
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _train_rows(bits: int):
    def run(batches):
        for batch in batches:
            body, at = raw(batch.column("text"))
            ids, labels, index, values = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), [], []
            for a, b in slices(at, SLICE):
                parts = features(body[at[a] : at[b]], at[a : b + 1] - at[a], bits)
                for k in range(b - a):
                    i, x = sparse_row(parts, k)
                    index.append(i.astype("<u4").tobytes())
                    values.append(x.astype("<f4").tobytes())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int32()), "index": pa.array(index, pa.binary()), "x": pa.array(values, pa.binary())})

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, left_out: int = 1, bound: int = TRAIN_ROWS, bits: int = BITS) -> np.ndarray:
    """The weight table (its last entry the bias), fitted on the driver on at most `bound` sparse rows."""
    sample = training_sample(pick(docs), labels, label, modulus, left_out, bound)
    got = sample.mapInArrow(_train_rows(bits), "doc_id long, label int, index binary, x binary").toArrow().sort_by("doc_id")
    rows = [(y, np.frombuffer(i, "<u4").astype(np.int64), np.frombuffer(x, "<f4").astype(np.float64)) for y, i, x in zip(got["label"].to_pylist(), got["index"].to_pylist(), got["x"].to_pylist())]
    return fit(rows, bits)


def score_documents(docs: DataFrame, weights: np.ndarray, modulus: int = 3, left_out: int = 1, threshold: float = 0.5, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    table = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            body, at = raw(batch.column("text"))
            parts = [score(body[at[a] : at[b]], at[a : b + 1] - at[a], table.value, bits) for a, b in slices(at, SLICE)]
            scores = np.concatenate([*parts, np.empty(0)])
            held = crc_mod(batch.column("doc_id"), modulus) == left_out
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": pa.array(held), "score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32))})

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
