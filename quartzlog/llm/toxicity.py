"""Toxicity by maximum-scoring segments of token log-odds.

Token weights: in how many toxic and clean training texts a (hashed) form occurs gives a log-odds ratio under
Dirichlet priors about the form's overall rate; what counts is its lower confidence bound, less a margin, so
that ordinary forms score below zero. A token's forms are the token itself and its first PREFIXES bytes, which stand for
inflected words that were not seen; the highest weight is the token's. A linear scan finds all maximal segments of positive total (passages). How high
the best passage of a clean text gets by chance follows an extreme-value law, P(best >= s) = 1 - exp(-K n exp(-lambda s))
for n tokens; K and lambda are fitted on clean rows, each scored by weights that it had no part in. A passage is significant if its
expected number in clean text is below one. All significant passages of a document are aggregated by the sum statistic of
that law: how often r passages whose normalised totals come to as much are to be expected, for the r that says most. A
document's score is a logistic function of the logarithm of that expectation, fitted on the same calibration rows.

Weights, law and logistic function are fitted on at most `bound` labelled rows (TRAIN_ROWS by default, those of lowest
hashed id); near copies among them count once. Their texts stay on the executors: the driver gets a signature and the
segment totals of each row and the counts by form. The table has 2**BITS weights whatever the corpus. Scores cover whole texts.

Cases: a null text counts as empty and has no passage; rows with null id or label do not train; without toxic training
rows no document has a passage; repeated rows are scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import LOWER, PUNCT, crc_mod, durable, give_back, mix, pick, raw, slices, span_hashes, training_sample, word_spans

BITS = 20
TRAIN_ROWS = 16000
SLICE = 2 << 20
THRESHOLD = 0.3
FOLDS = 3  # parts of the training rows that calibrate in turn
PREFIXES = (6,)  # bytes
HASHES = 8


@dataclass
class Model:
    weights: np.ndarray  # by token bucket
    lam: float
    k: float
    bias: float
    slope: float


def tokens(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (a row a token, a column a form) of the tokens, runs of letters, digits and non-ASCII characters, and the n + 1
    offsets of the texts' runs. A token no longer than a prefix has itself in that column."""
    if not len(body):
        return np.empty((0, 1 + len(PREFIXES)), np.int64), np.zeros(len(at), np.int64)
    body = LOWER[body]
    begin, end = word_spans(body, at, PUNCT)
    own = span_hashes(body, begin, end)
    forms = [own]
    for size in PREFIXES:
        longer = end - begin > size
        form = own.copy()
        form[longer] = mix(span_hashes(body, begin[longer], begin[longer] + size) ^ np.uint64(size))
        forms.append(form)
    return (np.stack(forms, 1) >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(begin, at)


def token_weights(weights: np.ndarray, forms: np.ndarray) -> np.ndarray:
    return weights[forms].max(1).astype(np.float64) if len(forms) else np.empty(0)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, prior: float = 10.0, z: float = 2.5, margin: float = 0.5) -> np.ndarray:
    """Weights, at least -margin - 4, from the numbers of toxic and clean rows that have a token of each bucket.

    Whether a row has the token is drawn from a rate with a Dirichlet prior of weight `prior` about its overall rate, and a
    half besides. Positive log-odds count by their lower confidence bound.
    """
    both = toxic + clean
    if not n_toxic or not n_clean:
        return np.full(len(toxic), -margin)
    a = 0.5 + prior * both / (n_toxic + n_clean)
    b = 0.5 + prior * (1 - both / (n_toxic + n_clean))
    odds = lambda x, n: np.log(x + a) - np.log(n - x + b)
    delta = odds(toxic, n_toxic) - odds(clean, n_clean)
    spread = np.sqrt(1 / (toxic + a) + 1 / (clean + a))
    bound = np.where(delta > 0, np.maximum(delta - z * spread, 0), np.maximum(delta, -4.0))
    return np.where(both > 0, bound, 0.0) - margin


def segments(weights: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, float]]:
    """All maximal scoring segments as (text, begin, end, total), over texts laid end to end; positions are the text's own.

    Runs of positive tokens come from left to right. A run joins the stretch back to the last earlier segment that begins at a
    lower cumulative sum, if that one also ends at a lower sum; otherwise it stands. Each segment remembers that earlier one,
    and the search goes from there, so that no segment is passed twice and time is linear.
    """
    out = []
    hot = np.flatnonzero(weights > 0)
    text_of = np.searchsorted(ends, hot, "right") - 1
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    begin = 0
    while begin < len(hot):
        text, end = text_of[begin], begin
        while end < len(hot) and text_of[end] == text:
            end += 1
        found: list[list] = []  # [left sum, right sum, begin, end, the last earlier one with a lower left sum]
        k = begin
        while k < end:
            first = hot[k]
            while k + 1 < end and hot[k + 1] == hot[k] + 1:
                k += 1
            left, right, since, until = sums[first], sums[hot[k] + 1], first, hot[k] + 1
            k += 1
            j = len(found) - 1
            while True:
                while j >= 0 and found[j][0] >= left:
                    j = found[j][4]
                if j < 0 or found[j][1] >= right:
                    found.append([left, right, since, until, j])
                    break
                left, since, back = found[j][0], found[j][2], found[j][4]
                del found[j:]
                j = back
        out += [(int(text), int(b - ends[text]), int(e - ends[text]), float(r - l)) for l, r, b, e, _ in found]
        begin = end
    return out


def best(found: list[tuple], n: int) -> np.ndarray:
    """Each of n texts' highest total of a segment, 0 without one."""
    out = np.zeros(n)
    if found:
        np.maximum.at(out, [f[0] for f in found], [f[3] for f in found])
    return out


def log_expected(model: Model, top: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Natural logarithm of the number of passages of at least this total that a clean text of n tokens is expected to have."""
    return np.log(model.k) + np.log(np.maximum(n, 1)) - model.lam * top


def aggregate(model: Model, found: list[tuple], n: np.ndarray) -> np.ndarray:
    """Per text of n tokens the logarithm of the expectation of its passages taken together.

    With x = lambda * total - ln(K n) of the r best significant passages summing to T, r passages come to T or more about
    exp(-T) T**(r - 1) / (r! (r - 1)!) times in clean text. T counts as r * r at least in the power, where the formula would
    fall short, and each further passage costs a factor of 2, as the best r is chosen. One passage has its own expectation.
    """
    out = log_expected(model, best(found, len(n)), n)
    by: dict[int, list[float]] = {}
    for text, _, _, total in found:
        x = -float(log_expected(model, np.array([total]), n[text : text + 1])[0])
        if x > 0:
            by.setdefault(text, []).append(x)
    for text, values in by.items():
        if len(values) > 1:
            t = np.cumsum(np.sort(values)[::-1])
            r = np.arange(1, len(t) + 1)
            factorial = np.concatenate([[0.0], np.cumsum(np.log(r))])
            out[text] = (-t + (r - 1) * np.log(2 * np.maximum(t, r * r)) - factorial[r] - factorial[r - 1]).min()
    return out


def law(top: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K by maximum likelihood from clean rows' best totals and lengths.

    A row without a passage tells that its best total is not above 0. The highest hundredth is left out: some rows are
    mislabelled. For a given lambda the best K is explicit; lambda is found by a search that narrows its interval.
    """
    if not len(top) or not (top > 0).any():
        return 1.0, 1.0 / max(1.0, float(n.sum()))
    some = top <= np.quantile(top, 0.99)
    s, n = top[some], np.maximum(n[some], 1).astype(np.float64)
    seen = max(1, int((s > 0).sum()))
    best_k = lambda lam: seen / float((n * np.exp(-lam * s)).sum())

    def likelihood(lam: float) -> float:
        return seen * (np.log(best_k(lam)) + np.log(lam)) - lam * float(s.sum())

    low, high = 0.2, 10.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if likelihood(a) > likelihood(b) else (a, high)
    return low, best_k(low)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by damped Newton steps on the standardised values, with a small ridge."""
    mean, scale = float(x.mean()), max(1e-9, float(x.std()))
    a = np.stack([np.ones(len(x)), (x - mean) / scale], 1)
    b = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -35, 35)))
        grad = a.T @ (p - y) + 0.1 * b
        hess = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= step * min(1.0, 1.0 / max(1e-12, float(np.abs(step).max())))
    return float(b[0] - b[1] * mean / scale), float(b[1] / scale)


def signature(forms: np.ndarray) -> list[int]:
    """The least values of HASHES hash functions over a row's tokens; none without tokens."""
    factor = np.random.default_rng(7).integers(1, 1 << 31, HASHES).astype(np.int64) | 1
    return (forms[:, :1].astype(np.int64) * factor % 2147483647).min(0).tolist() if len(forms) else []


def without_near_copies(signatures: list[list[int]], agree: int = 5) -> list[int]:
    """Rows of which no earlier row shares `agree` values of the signature: near copies of a toxic text would make its
    ordinary words look toxic."""
    seen: list[dict[int, list[int]]] = [{} for _ in range(HASHES)]
    out = []
    for k, least in enumerate(signatures):
        votes: dict[int, int] = {}
        for table, value in zip(seen, least):
            for j in table.get(value, ()):
                votes[j] = votes.get(j, 0) + 1
        if not votes or max(votes.values()) < agree:
            out.append(k)
            for table, value in zip(seen, least):
                table.setdefault(value, []).append(k)
    return out


def fold_weights(counts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Weights from the rows outside each fold, and last from all rows. counts: by fold, label and bucket; sizes: by fold and label."""

    some = np.flatnonzero(counts.any((0, 1)))  # all others have the weight of a form that was not seen

    def weights(use: list[int]) -> np.ndarray:
        clean, toxic = counts[use][:, :, some].sum(0, dtype=np.float64)
        n_clean, n_toxic = sizes[use].sum(0)
        out = np.full(counts.shape[2], log_odds(np.zeros(1), np.zeros(1), n_toxic, n_clean)[0], np.float32)
        out[some] = log_odds(toxic, clean, n_toxic, n_clean)
        return out

    every = list(range(FOLDS))
    return [weights([g for g in every if g != f]) for f in every] + [weights(every)]


def calibrated(weights: np.ndarray, y: np.ndarray, n: np.ndarray, totals: list) -> Model:
    """The model from each row's label, number of tokens and segments' totals under weights that it had no part in."""
    found = [(k, 0, 0, t) for k, own in enumerate(totals) for t in own]
    top = best(found, len(n))
    model = Model(weights, *law(top[y == 0], n[y == 0]), -2.0, -1.0)
    if (y == 1).sum() >= 5 and (y == 0).sum() >= 5:
        model.bias, model.slope = logistic(aggregate(model, found, n), y)
    return model


def score(model: Model, buckets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Scores in 0..1 of texts, and their segments."""
    found, n = segments(token_weights(model.weights, buckets), ends), np.diff(ends)
    out = 1 / (1 + np.exp(-np.clip(model.bias + model.slope * aggregate(model, found, n), -35, 35)))
    return np.where(best(found, len(n)) > 0, out, np.minimum(out, 0.01)), found


def _sample_rows(batches):
    for batch in batches:
        body, at = raw(batch.column("text"))
        found = []
        for a, b in slices(at, SLICE):
            forms, ends = tokens(body[at[a] : at[b]], at[a : b + 1] - at[a])
            found += [forms[ends[k] : ends[k + 1]] for k in range(b - a)]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "signature": pa.array([signature(x) for x in found], pa.list_(pa.int64())), "forms": pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())})


def _forms(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4").reshape(-1, 1 + len(PREFIXES)).astype(np.int64) for x in batch.column("forms").to_pylist()]


def _count(batches):
    """Rows (key, n): in how many texts a bucket occurs; key holds fold, label and bucket."""
    for batch in batches:
        keys = [np.unique(x) + ((f * 2 + y) << BITS) for x, f, y in zip(_forms(batch), batch.column("fold").to_pylist(), batch.column("label").to_pylist())]
        key, n = np.unique(np.concatenate([*keys, np.empty(0, np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})


def _totals(shared):
    def run(batches):
        for batch in batches:
            forms = _forms(batch)
            totals = [[f[3] for f in segments(token_weights(shared.value[fold], x), np.array([0, len(x)]))] for x, fold in zip(forms, batch.column("fold").to_pylist())]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "n": pa.array([len(x) for x in forms], pa.int64()), "totals": pa.array(totals, pa.list_(pa.float64()))})

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, left_out: int = 2, bound: int = TRAIN_ROWS) -> Model:
    """The model, fitted on at most `bound` labelled rows. Every third row in turn is scored by weights from the others, which
    calibrates the law and the logistic function; the weights kept come from all rows."""
    spark = docs.sparkSession
    sample = durable(training_sample(pick(docs), labels, label, modulus, left_out, bound).mapInArrow(_sample_rows, "doc_id long, label int, signature array<long>, forms binary"))
    heads = sample.select("doc_id", "label", "signature").toArrow().sort_by("doc_id")
    kept = without_near_copies(heads["signature"].to_pylist())
    ids, y = heads["doc_id"].to_pylist(), heads["label"].to_pylist()
    folds = spark.createDataFrame([(ids[k], at % FOLDS) for at, k in enumerate(kept)], "doc_id long, fold int")  # at most `bound` rows
    rows = sample.drop("signature").join(F.broadcast(folds), "doc_id")
    counts, sizes = np.zeros(FOLDS * 2 << BITS, np.float32), np.zeros((FOLDS, 2))
    got = rows.mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts[got["key"].to_numpy()] = got["n"].to_numpy()
    np.add.at(sizes, (np.arange(len(kept)) % FOLDS, [y[k] for k in kept]), 1)
    weights = fold_weights(counts.reshape(FOLDS, 2, -1), sizes)
    found = rows.mapInArrow(_totals(spark.sparkContext.broadcast(weights[:FOLDS])), "doc_id long, label int, n long, totals array<double>").toArrow().sort_by("doc_id")
    model = calibrated(weights[FOLDS], found["label"].to_numpy(), found["n"].to_numpy(), found["totals"].to_pylist())
    del heads, counts, got, found, weights
    give_back()
    return model


def _scored(docs: DataFrame, model: Model, modulus: int, left_out: int, threshold: float, id_col: str, text_col: str, spans: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            body, at = raw(batch.column("text"))
            scores, passages = [np.empty(0)], []
            for a, b in slices(at, SLICE):
                buckets, ends = tokens(body[at[a] : at[b]], at[a : b + 1] - at[a])
                own_scores, found = score(model, buckets, ends)
                scores.append(own_scores)
                if spans:
                    own = [[] for _ in range(b - a)]
                    n = np.diff(ends)
                    for t, begin, end, total in found:
                        value = float(log_expected(model, np.array([total]), n[t : t + 1])[0])
                        if value < 0:
                            own[t].append({"first_token": begin, "end_token": end, "total": total, "log_expected": value})
                    passages += own
            scores = np.concatenate(scores)
            held = crc_mod(batch.column("doc_id"), modulus) == left_out
            columns = {"doc_id": batch.column("doc_id"), "held_out": pa.array(held), "score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32))}
            if spans:
                columns["passages"] = pa.array(passages, pa.list_(pa.struct([("first_token", pa.int64()), ("end_token", pa.int64()), ("total", pa.float64()), ("log_expected", pa.float64())])))
            yield pa.RecordBatch.from_pydict(columns)

    kind = "doc_id long, held_out boolean, score double, predicted int"
    return pick(docs, id_col, text_col).mapInArrow(run, kind + (", passages array<struct<first_token:long,end_token:long,total:double,log_expected:double>>" if spans else ""))


def score_documents(docs: DataFrame, model: Model, modulus: int = 4, left_out: int = 2, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, passages (all significant ones) for every document."""
    return _scored(docs, model, modulus, left_out, threshold, id_col, text_col, True)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs scored below the threshold, with all their columns; each row is judged in place, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    position, source = docs.columns.index(text_col), docs.schema

    def run(batches):
        for batch in batches:
            body, at = raw(batch.column(position))
            keep = [np.empty(0, bool)]
            for a, b in slices(at, SLICE):
                keep.append(score(shared.value, *tokens(body[at[a] : at[b]], at[a : b + 1] - at[a]))[0] < threshold)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, source)
