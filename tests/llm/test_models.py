import collections
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quartzlog.llm import lm, quality, toxicity

rng = random.Random(11)
WORDS = ["w%d" % k for k in range(300)]
EDGE = [(None, "w1 w2"), (-5, None), (-6, ""), (-7, " \t"), (-8, "W1 W1  w2\n"), (-9, "x" * 9000), (-9, "x" * 9000), (-10, "é ñ É w3")]


def text(n, extra=()):
    return " ".join([rng.choice(WORDS) for _ in range(n)] + list(extra))


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 1, True, 9) for i, t in rows], "doc_id long, text string, score double, label int, held_out boolean, n_tokens int").repartition(3)


def mod(i, m):
    return zlib.crc32(b"" if i is None else str(i).encode()) % m


def words_of(t):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().lower()) if w]


@pytest.fixture(scope="module")
def corpus():
    return [(i, text(rng.choice([1, 5, 60, 300]))) for i in range(200)] + EDGE


def test_language_model(spark, corpus):
    got = lm.score_documents(docs_frame(spark, corpus)).collect()
    tokens = {id(r): [*words_of(r[1]), None] for r in corpus}
    counts, pairs = Counter(), Counter()
    for r in corpus:
        if mod(r[0], 7) != 2:
            counts.update(tokens[id(r)])
            pairs.update(zip([0, *tokens[id(r)]], tokens[id(r)]))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r[0]), len(tokens[id(r)]), sum(counts[w] > 0 for w in tokens[id(r)]), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[id(r)]), 6)) for r in corpus)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["held_out"] == (mod(r["doc_id"], 7) == 2) for r in got)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_score_is_the_mixture(spark, corpus):
    """The whole model once more in plain Python: deleted counts, histogram, weights, scores."""
    got = {}
    for r in lm.score_documents(docs_frame(spark, corpus)).collect():
        got.setdefault(r["doc_id"], r["score"])
    every = {"c": Counter(), "p": Counter()}
    held = {"c": Counter(), "p": Counter()}
    for i, t in corpus:
        ws = [*words_of(t), None]
        if mod(i, 7) != 2:
            for side in [every] + [held] * (mod(i, 7) == 5):
                side["c"].update(ws)
                side["p"].update(zip([0, *ws], ws))
    n, v, nh = sum(every["c"].values()), len(every["c"]), sum(held["c"].values())
    context = lambda c, h: c["c"][None if h == 0 else h]
    bins = Counter()
    for i, t in corpus:
        if mod(i, 7) == 5:
            ws = [*words_of(t), None]
            for h, w in zip([0, *ws], ws):
                ch, cw, cp = context(every, h) - context(held, h), every["c"][w] - held["c"][w], every["p"][h, w] - held["p"][h, w]
                p = [cp / max(ch, 1), cw / max(n - nh, 1), 1 / (v + 1)]
                ratio = [int(np.round(8 * np.log2(x / p[2]))) if x > 0 else -(1 << 15) for x in p[:2]]
                bins[int(lm.context_bucket(np.array([ch]))[0]), *ratio] += 1
    keys = sorted(bins)
    weights = lm.learn(*(np.array([k[j] for k in keys]) for j in range(3)), np.array([bins[k] for k in keys]))
    assert np.allclose(weights.sum(1), 1, atol=1e-6)
    for i, t in corpus:
        total, ws = 0.0, [*words_of(t), None]
        for h, w in zip([0, *ws], ws):
            ch = context(every, h)
            own = weights[int(lm.context_bucket(np.array([ch]))[0])]
            total += math.log10(own @ np.array([every["p"][h, w] / max(ch, 1), every["c"][w] / n, 1 / (v + 1)]))
        assert got[i] == pytest.approx(total, rel=1e-6)


def test_learned_weights_beat_fixed_ones():
    """Expectation-maximisation does not lower the held-out likelihood."""
    context, pair, word, tokens = np.array([1, 1, 2, 2]), np.array([40, -(1 << 15), 8, 60]), np.array([30, 2, 20, 4]), np.array([50, 30, 9, 40])
    found = lm.learn(context, pair, word, tokens)
    ratio = np.stack([np.where(x > -(1 << 15), np.exp2(np.clip(x, -800, 800) / lm.STEPS), 0) for x in (pair, word)] + [np.ones(4)], 1)
    value = lambda w: (tokens * np.log((ratio * w).sum(1))).sum()
    assert value(found[context]) >= max(value(np.array(w)) for w in ([1 / 3] * 3, [0.5, 0.4, 0.1], [0.1, 0.8, 0.1]))


def test_language_model_of_empty_tables(spark):
    assert lm.score_documents(docs_frame(spark, []).coalesce(1)).count() == 0
    only_left_out = [i for i in range(60) if mod(i, 7) == 2]
    rows = lm.score_documents(docs_frame(spark, [(i, "a b") for i in only_left_out])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in rows) and len(rows) == len(only_left_out)


def labelled(spark, make, n=900):
    rows, labels = [], []
    for i in range(n):
        t, y = make(i)
        rows.append((i, t))
        labels.append((i, y, y))
    labels += [(None, 1, 1), (5, None, None), (10**9, 1, 0)]
    return docs_frame(spark, rows + EDGE), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((i, y) for i, y, _ in labels if i is not None and y is not None)


def test_quality(spark):
    junk = lambda: " | ".join(rng.choice(WORDS) for _ in range(30)) if rng.random() < 0.5 else (rng.choice(WORDS).upper() + "!! ") * 20
    docs, labels, truth = labelled(spark, lambda i: (text(60), 1) if i % 4 else (text(8) + junk(), 0))
    weights = quality.train(docs, labels, bound=300)
    got = quality.score_documents(docs, weights).collect()
    assert len(got) == 908 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (mod(r["doc_id"], 3) == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    same = [r["score"] for r in got if r["doc_id"] in (-5, -6, -7)]
    assert len(set(same)) == 1
    none = quality.train(docs, labels.where("doc_id < 0"))
    assert {r["score"] for r in quality.score_documents(docs, none).collect()} == {0.5}


def test_ftrl_separates_and_stays_sparse():
    rows = [(y, np.array([y, 5 + k % 50]), np.array([1.0, 1.0])) for k in range(400) for y in (0, 1)]
    w = quality.fit(rows, bits=10)
    assert w[1] > 0.3 > -0.3 > w[0] and (w != 0).sum() < 60


def test_features_do_not_cross_texts():
    from quartzlog.llm._common import raw

    import pyarrow as pa

    together = quality.features(*raw(pa.array(["a b c", "", "d", "e f"])))
    for k, t in enumerate(["a b c", "", "d", "e f"]):
        alone = quality.features(*raw(pa.array([t])))
        for (i, ends), (j, _) in zip(together, alone):
            assert i[ends[k] : ends[k + 1]].tolist() == j.tolist()


def brute_segments(weights):
    """All maximal scoring segments by definition: recursively the best one, then those on either side."""
    best = None
    for a in range(len(weights)):
        total = 0.0
        for b in range(a, len(weights)):
            total += weights[b]
            if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                best = (total, a, b + 1)
    if best is None:
        return []
    total, a, b = best
    return brute_segments(weights[:a]) + [(a, b, total)] + [(b + x, b + y, s) for x, y, s in brute_segments(weights[b:])]


def test_segments_are_the_maximal_ones():
    source = np.random.default_rng(2)
    texts = [source.normal(-0.3, 1, n).round(3) for n in (0, 1, 7, 40, 25)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat = np.concatenate(texts)
    got = toxicity.segments(flat, ends)
    best = toxicity.best(got, len(texts))
    for k, t in enumerate(texts):
        want = brute_segments(t.tolist())
        assert sorted((a, b, round(s, 6)) for d, a, b, s in got if d == k) == sorted((a, b, round(s, 6)) for a, b, s in want)
        assert best[k] == pytest.approx(max((s for _, _, s in want), default=0))


def test_toxicity(spark):
    bad = ["vile%d" % k for k in range(12)]
    docs, labels, truth = labelled(spark, lambda i: (text(80, rng.sample(bad, 4) + ["w5"] * 9), 1) if i % 8 == 0 else (text(rng.choice([5, 90])), 0), 2400)
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (mod(r["doc_id"], 4) == 2) for r in got)
    caught = sum(r["predicted"] for r in held if truth[r["doc_id"]]) / sum(truth[r["doc_id"]] for r in held)
    wrong = sum(r["predicted"] for r in held if not truth[r["doc_id"]]) / len(held)
    assert caught > 0.95 and wrong < 0.02
    assert all(r["passages"] for r in held if r["predicted"] and r["score"] > 0.9)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {r["doc_id"] for r in got if not r["predicted"]}
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    clean = toxicity.train(docs, labels.where("toxic = 0"))
    assert not any(r["predicted"] for r in toxicity.score_documents(docs, clean).collect())


def test_empty_tables(spark):
    docs = docs_frame(spark, []).coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_documents(docs, quality.train(docs, labels)).count() == 0
    assert toxicity.score_documents(docs, toxicity.train(docs, labels)).count() == 0


def test_segments_take_linear_time():
    import time

    def seconds(n):
        flat, best = np.tile([1.0, -2.0], n), []
        for _ in range(3):
            start = time.perf_counter()
            assert len(toxicity.segments(flat, np.array([0, 2 * n]))) == n
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(64000) < 4 * 2 * seconds(16000)  # a square would be 16-fold


def test_passages_add_up():
    model = toxicity.Model(np.zeros(1), 1.0, 0.01, 0.0, -1.0)
    n = np.array([100] * 5)
    found = [(1, 0, 1, 3.0), (2, 0, 1, 3.0), (2, 5, 6, 3.0), (2, 8, 9, 3.0), (3, 0, 1, 0.1), (3, 4, 5, 0.1), (4, 0, 1, 9.0)]
    got = toxicity.aggregate(model, found, n)

    def want(totals):
        xs = sorted((t - math.log(0.01 * 100) for t in totals if t - math.log(0.01 * 100) > 0), reverse=True)
        best = math.log(0.01 * 100) - max(totals, default=0.0)
        for r in range(2, len(xs) + 1):
            t = sum(xs[:r])
            best = min(best, -t + (r - 1) * math.log(max(t, r * r)) - math.log(math.factorial(r) * math.factorial(r - 1)) + (r - 1) * math.log(2))
        return best

    assert got.tolist() == pytest.approx([want([f[3] for f in found if f[0] == k]) for k in range(5)])
    assert got[2] < got[1] < got[0] and got[3] == pytest.approx(-0.1)  # three passages tell more than one; two slight ones do not


def test_toxicity_against_plain_counts(spark):
    bad = ["vile%d" % k for k in range(6)]
    docs, labels, truth = labelled(spark, lambda i: (text(30, rng.sample(bad, 2)), 1) if i % 6 == 0 else (text(30), 0), 700)
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    bucket = lambda w: toxicity.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0].tolist()
    words = {i: [bucket(w) for w in re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))] for i, t in rows.items()}
    train = sorted(i for i in truth if mod(i, 4) != 2 and i in rows)
    kept = [train[k] for k in toxicity.without_near_copies([toxicity.signature(np.array(words[i]).reshape(-1, 1 + len(toxicity.PREFIXES))) for i in train])]
    toxic_of = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    df = [collections.Counter(), collections.Counter()]
    size = [0, 0]
    for i in kept:
        size[toxic_of[i]] += 1
        df[toxic_of[i]].update({b for forms in words[i] for b in forms})

    def weight(b):
        t, c = df[1][b], df[0][b]
        if not t + c:
            return -0.5
        rate = (t + c) / sum(size)
        a, z = 0.5 + 10 * rate, 0.5 + 10 * (1 - rate)
        delta = math.log((t + a) / (size[1] - t + z)) - math.log((c + a) / (size[0] - c + z))
        return (max(0.0, delta - 2.5 * math.sqrt(1 / (t + a) + 1 / (c + a))) if delta > 0 else max(delta, -4.0)) - 0.5

    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    for i in list(words)[:150]:
        line = [max(map(weight, forms)) for forms in words[i]]
        found = [(0, a, b, s) for a, b, s in brute_segments(line)]
        value = float(toxicity.aggregate(model, found, np.array([len(line)]))[0])
        want = 1 / (1 + math.exp(-max(-35, min(35, model.bias + model.slope * value))))
        assert got[i] == pytest.approx(want if found else min(want, 0.01), abs=2e-3), i


def test_quality_scores_against_plain_features(spark):
    from quartzlog.llm._common import mix, span_hashes

    weights = np.random.default_rng(2).normal(0, 0.5, (1 << quality.BITS) + 1).astype(np.float32)
    texts = ["", None, "One two two THREE! a1 9", "x", " lead  trail ", "É é 12 12 12", "w" * 40 + " W" + "w" * 39, "A b\tC\nd e-f"]
    whole = (1 << 64) - 1
    spread = lambda x: int(mix(np.array([x & whole], np.uint64))[0])

    def plain(t):
        raw_words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode()) if w]
        hashes, shapes = [], []
        for k, w in enumerate(raw_words):
            low = w.lower()
            hashes.append(int(span_hashes(np.frombuffer(low, np.uint8), np.array([0]), np.array([len(low)]))[0]))
            up, lo, di, hi = (sum(f(c) for c in w) for f in (lambda c: 65 <= c < 91, lambda c: 97 <= c < 123, lambda c: 48 <= c < 58, lambda c: c >= 128))
            shape = min(up, 2) + (up == len(w))
            for x in (min(lo, 1) + (lo == len(w)), min(di, 1) + (di == len(w)), min(len(w) - up - lo - di - hi, 3), int(k > 0 and hashes[k] == hashes[k - 1])):
                shape = shape * 4 + x
            shapes.append(spread(shape + 99))
        total = float(weights[-1])
        for stream, orders, salt in ((hashes, 2, 1), (shapes, 3, 11)):
            grams = stream
            for order in range(1, orders + 1):
                if order > 1:
                    grams = [spread(g * 0x9E3779B97F4A7C15 + x) for g, x in zip(grams, stream[order - 1 :])]
                if grams:
                    total += quality.SCALE * sum(float(weights[spread(g + salt + order) & (1 << quality.BITS) - 1]) for g in grams) / len(grams)
        return 1 / (1 + math.exp(-total))

    docs = docs_frame(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, weights).collect()}
    assert all(got[k] == pytest.approx(plain(t), rel=1e-5) for k, t in enumerate(texts))


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def test_patterned_words_are_told_apart(spark):
    one, other = thue_morse(2048), thue_morse(2048, "b", "a")
    train, held = next(i for i in range(99) if mod(i, 7) != 2), next(i for i in range(99) if mod(i, 7) == 2)
    got = {r["doc_id"]: r for r in lm.score_documents(docs_frame(spark, [(train, one), (held, other)])).collect()}
    assert (got[train]["n_known"], got[held]["n_known"], got[held]["n_tokens"]) == (2, 1, 2)
    assert got[held]["base_score"] == pytest.approx(math.log10(1 / 5) + math.log10(2 / 5))
