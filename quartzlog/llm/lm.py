"""Language-model scoring by deleted interpolation.

P(w | h) mixes the maximum-likelihood bigram c(h, w) / c(h), the unigram c(w) / N and the uniform 1 / (V + 1). The three
weights depend on the bucket (power of two) of the context's frequency c(h) and are learned by expectation-maximisation
on held-out counts: one fold of the training documents (HELD_OUT) is deleted from the counts, and the weights maximise
the likelihood of that fold under the counts of the others. The final scores use the counts of all training documents.

Counts cover every training document. Words are told apart by 64 bits: of their bytes up to 16, mixed, or a seeded XXH3.
Pairs are told apart by 48 bits: of m distinct pairs about a share m / 2**48 has the key of another one and counts with it
(4e-7 for 10**8 pairs, 4e-3 for 10**12); only the pairs' estimates see that, n_known and base_score do not. Counts are merged by the exchange of `_blocks`, so no vocabulary is ever in one place. The held-out fold's tokens reach the driver
only as a histogram over (context bucket, log-ratio of the estimates), whose size does not depend on the corpus.

Cases: a null text counts as empty and is one end token; a null id counts as the empty text in folds; without training
rows N = V = 0 and every estimate but the uniform is 0; repeated rows all count; an empty table gives no rows; other
columns are not read; texts of any length are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import PACKED, blocks, bucket_cuts, by_key, get_ints, get_keys, grouped, put_block, put_ints, put_keys, unpack, with_replies
from ._common import crc_mod, durable, give_back, mix, partitions, raw, slices, word_hashes

MODULUS, LEFT_OUT, HELD_OUT = 7, 2, 5
END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
PAIR_BITS = 48
STEPS = 8  # histogram steps per factor of two
CONTEXTS = 40
TOKEN_SLICE = 4 << 20


def token_stream(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and one END, and the n + 1 offsets of the texts' runs."""
    parts, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for a, b in slices(at, TOKEN_SLICE):
        words, n = word_hashes(body[at[a] : at[b]], at[a : b + 1] - at[a])
        parts.append(words)
        counts.append(n)
    counts = np.concatenate(counts)
    ends = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(ends[-1], END, np.uint64)
    inner = np.ones(ends[-1], bool)
    inner[ends[1:] - 1] = False
    out[inner] = np.concatenate(parts)
    return out, ends


def pair_keys(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[ends[:-1]] = START
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens) >> np.uint64(64 - PAIR_BITS)


def folds(ids: list, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token: whether its document trains, and whether it is in the held-out fold."""
    fold = crc_mod(pa.array(ids, pa.int64()), MODULUS)
    return np.repeat(fold != LEFT_OUT, np.diff(ends)), np.repeat(fold == HELD_OUT, np.diff(ends))


def distinct(keys: np.ndarray, *marks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and, per mark, how many of a key's places are marked."""
    if not len(keys):
        return keys, *(np.empty(0, np.int64) for _ in marks)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], *(np.add.reduceat(m[order].astype(np.int64), first) for m in marks)


def _ask(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, body, at = unpack(row["ids"], row["payload"])
                tokens, ends = token_stream(body, at)
                trains, held = folds(ids, ends)
                found = [distinct(tokens, trains, held), distinct(pair_keys(tokens, ends), trains, held)]
                cuts = [bucket_cuts(found[0][0], 64, buckets), bucket_cuts(found[1][0], PAIR_BITS, buckets)]
                for i in range(buckets):
                    own = [[x[c[i] : c[i + 1]] for x in f] for f, c in zip(found, cuts)]
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([i], pa.int32()), "block": pa.array([row["block"]], pa.int64())} | {f"{k}{o}": pa.array([put(x)], pa.binary()) for o, part in enumerate(own) for k, put, x in zip("kth", (put_keys, put_ints, put_ints), part)})
        give_back()

    return run


ASKED = "bucket int, block long, k0 binary, t0 binary, h0 binary, k1 binary, t1 binary, h1 binary"


def _put(values: np.ndarray) -> bytes:
    data = put_ints(values)
    return len(data).to_bytes(8, "little") + data


def _answer(batches):
    """Per bucket: each block's keys' totals over all blocks, and those of its held-out texts' keys with the fold's part; and one row (block null) with the bucket's part of N and V."""
    for bucket, rows in grouped(batches, "bucket"):
        replies, dev = [b""] * len(rows), [b""] * len(rows)
        sums = [0, 0, 0]
        for o in (0, 1):
            keys = [get_keys(r[f"k{o}"]) for r in rows]
            every, where = np.unique(np.concatenate(keys), return_inverse=True)
            asked = np.concatenate([get_ints(r[f"h{o}"]) for r in rows])
            total = np.bincount(where, np.concatenate([get_ints(r[f"t{o}"]) for r in rows]), len(every)).astype(np.int64)
            held = np.bincount(where, asked, len(every)).astype(np.int64)
            if not o:
                sums = [int(total.sum()), int((total > 0).sum()), int(held.sum())]
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            for i in range(len(rows)):
                own = where[at[i] : at[i + 1]]
                replies[i] += _put(total[own])
                own = own[asked[at[i] : at[i + 1]] > 0]
                dev[i] += _put(total[own]) + _put(held[own])
        yield pa.RecordBatch.from_pydict({"block": pa.array([*(r["block"] for r in rows), None], pa.int64()), "bucket": pa.array([bucket] * (len(rows) + 1), pa.int32()), "payload": pa.array([*replies, None], pa.binary()), "dev": pa.array([*dev, None], pa.binary()), "n": pa.array([*[None] * len(rows), sums[0]], pa.int64()), "v": pa.array([*[None] * len(rows), sums[1]], pa.int64()), "held": pa.array([*[None] * len(rows), sums[2]], pa.int64())})


def _read_reply(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(get_ints(data[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


def _counted(rows: list[dict]):
    """A block's ids, its texts' token runs, and rows of counts (totals; if answered, the fold's part) of tokens, contexts and pairs."""
    ids, body, at = unpack(rows[0]["ids"], rows[0]["payload"])
    tokens, ends = token_stream(body, at)
    got = [np.concatenate(x) for x in zip(*(_read_reply(r["payload"]) for r in rows[1:]))]
    kinds = len(got) // 2
    _, where = np.unique(tokens, return_inverse=True)
    word = np.stack([x[where] for x in got[:kinds]])
    _, where = np.unique(pair_keys(tokens, ends), return_inverse=True)
    pair = np.stack([x[where] for x in got[kinds:]])
    context = np.empty_like(word)
    context[:, 1:] = word[:, :-1]
    context[:, ends[:-1]] = word[:, ends[1:] - 1]  # there are as many starts as ENDs
    return ids, ends, word, context, pair


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0), CONTEXTS - 1)


def estimates(word: np.ndarray, context: np.ndarray, pair: np.ndarray, n: int, v: int) -> np.ndarray:
    """Rows: the bigram, unigram and uniform estimates."""
    return np.stack([pair / np.maximum(context, 1), word / max(n, 1), np.full(len(word), 1 / (v + 1))])


def _only_held_out(batches):
    """Blocks cut down to the texts of the held-out fold."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, body, at = unpack(row["ids"], row["payload"])
            keep = np.flatnonzero(crc_mod(pa.array(ids, pa.int64()), MODULUS) == HELD_OUT)
            if len(keep):
                texts = pa.array([body[at[k] : at[k + 1]].tobytes() for k in keep], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(dict(zip(("block", "ids", "payload"), ([x] for x in (row["block"], *put_block(pa.array([ids[k] for k in keep], pa.int64()), *raw(texts)))))), pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("payload", pa.binary())]))


def _held_out(n: int, v: int, held_n: int):
    """Histogram rows (context bucket, log-ratio bigram to uniform, log-ratio unigram to uniform, tokens) of the held-out fold."""
    none = -(1 << 15)

    def run(batches):
        for _, rows in grouped(batches, "block"):
            if rows[0]["payload"] is None or rows[0]["ids"] is None:  # a block without texts of the fold
                continue
            _, _, word, context, pair = (x if k < 2 else x[0] - x[1] for k, x in enumerate(_counted(rows)))
            p = estimates(word, context, pair, n - held_n, v)
            ratio = [np.where(x > 0, np.round(STEPS * np.log2(np.where(x > 0, x, 1) / p[2])), none).astype(np.int64) for x in p[:2]]
            bins, tokens = np.unique(np.stack([context_bucket(context), *ratio]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_pydict({k: pa.array(x, pa.int64()) for k, x in zip(("context", "pair", "word", "tokens"), (*bins, tokens))})

    return run


def learn(context: np.ndarray, pair: np.ndarray, word: np.ndarray, tokens: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights (CONTEXTS x 3) by expectation-maximisation over the histogram; buckets without tokens take the overall weights."""
    ratio = np.stack([np.where(x > -(1 << 15), np.exp2(np.clip(x, -800, 800) / STEPS), 0.0) for x in (pair, word)] + [np.ones(len(tokens))], 1)

    def run(rows: np.ndarray) -> np.ndarray:
        weight = np.full(3, 1 / 3)
        for _ in range(rounds):
            part = ratio[rows] * weight
            part *= (tokens[rows] / part.sum(1))[:, None]
            weight = part.sum(0) + np.array([0.0, 0.0, 1e-6])
            weight /= weight.sum()
        return weight

    overall = run(np.arange(len(tokens))) if len(tokens) else np.array([0.4, 0.4, 0.2])
    out = np.tile(overall, (CONTEXTS, 1))
    for c in np.unique(context):
        out[c] = run(np.flatnonzero(context == c))
    return np.maximum(out, [0.0, 0.0, 1e-9])


def _score(n: int, v: int, weights: np.ndarray):
    def run(batches):
        for _, rows in grouped(batches, "block"):
            ids, ends, word, context, pair = (x if k < 2 else x[0] for k, x in enumerate(_counted(rows)))
            p = estimates(word, context, pair, n, v)
            mixed = np.log10(np.einsum("ij,ji->j", p, weights[context_bucket(context)]))
            base = np.log10((word + 1) / (n + v + 1))
            total = lambda x, ends=ends: np.add.reduceat(x, ends[:-1]) if len(ends) > 1 else np.empty(0)
            fold = crc_mod(pa.array(ids, pa.int64()), MODULUS)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(fold == LEFT_OUT), "n_tokens": pa.array(np.diff(ends), pa.int64()), "n_known": pa.array(total((word > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(len(ids), n), pa.int64()), "base_score": pa.array(total(base)), "score": pa.array(total(mixed))})
        give_back()

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    n = partitions(docs)
    packed = blocks(docs, id_col, text_col)
    asked = packed.mapInArrow(_ask(n), ASKED)
    answers = durable(by_key(asked, n, "bucket", "block").mapInArrow(_answer, "block long, bucket int, payload binary, dev binary, n long, v long, held long"))
    total, kinds, held = (int(x or 0) for x in answers.agg(F.sum("n"), F.sum("v"), F.sum("held")).first())
    replies = answers.where("block is not null")
    fold = packed.mapInArrow(_only_held_out, PACKED)
    bins = with_replies(fold, replies.withColumn("payload", F.col("dev")), n).mapInArrow(_held_out(total, kinds, held), "context long, pair long, word long, tokens long")
    got = bins.groupBy("context", "pair", "word").agg(F.sum("tokens").alias("tokens")).orderBy("context", "pair", "word").toArrow()
    weights = learn(*(got[c].to_numpy() for c in ("context", "pair", "word", "tokens")))
    return with_replies(packed, replies, n).mapInArrow(_score(total, kinds, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
