import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartzlog.llm import chat, mixing, packing, topk
from quartzlog.llm._common import durable

public_tokenizers = pytest.importorskip("public_tokenizers")
rng = random.Random(4)


def vocabulary(name="word_bpe_49k.json"):
    return public_tokenizers.path(name)


TRICKY = ["", " ", "Don't STOP, it's 3 o'clock!!", "Été à l'œuvre — naïve ﬁ Σίσυφος ΣΑΣ", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "x y z　w", "é ñ Å", "\x1c\x1f\x00 tab\tnew\nline\r\n", "𝔘𝔫𝔦 漢字 かな 😀👍🏽", "1234567890 a1b2", "''s 't're", "...!?---", "I'LL WE'VE they'd", "​zero‍"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers(name):
    import pyarrow as pa
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary(name))
    texts = TRICKY + [" ".join(rng.choice(TRICKY) for _ in range(5)) for _ in range(30)]
    ids, ends = packing.tokenizer(vocabulary(name)).texts(pa.array(["skip", *texts]).slice(1), 2)
    for k, t in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 2], t


def documents(spark):
    rows = [(k, " ".join(rng.choice(TRICKY[2:4]) for _ in range(rng.choice([0, 1, 5, 60]))), "big" if k % 3 else f"s{k % 4}") for k in range(400)]
    rows += [(None, None, None), (950, "again", "big"), (950, "again", "big"), (900, "word " * 30000, "long")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, offset int, part int").repartition(3)


def test_packing(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    rows, docs = documents(spark)
    pieces = packing.pack(docs, vocabulary())
    got = pieces.collect()
    want = collections.Counter()
    for i, t, _ in rows:
        want[i, zlib.crc32(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())] += 1
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, t, _ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by[i], key=lambda r: (r["start"], r["sequence_id"], r["offset"]))
        copies = sum(j == i for j, _, _ in rows)
        covered = collections.Counter()
        for r in own:
            assert r["doc_tokens"] == len(ids) and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            covered.update(range(r["start"], r["start"] + r["length"]))
        assert covered == {k: copies for k in range(len(ids))}
    sequence = collections.defaultdict(list)
    for r in got:
        sequence[r["sequence_id"]].append(r)
    for own in sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 4096 or at < 4096 and at & (at - 1) == 0
    assert packing.sequences(pieces).agg({"padding": "max"}).first()[0] == 0
    assert packing.pack(docs.limit(0).coalesce(1), vocabulary()).count() == 0


def test_windows_follow_the_targets():
    lengths = [rng.randint(20, 900) for _ in range(6000)]
    shares = [0.5, 0.3, 0.2]
    queue = [rng.choices(range(3), shares)[0] for _ in lengths]
    held = [sum(n for n, q in zip(lengths, queue) if q == k) for k in range(3)]
    target = [h / sum(held) for h in held]
    served = np.zeros(3)
    worst = 0.0
    total = 0
    for doc, start, length, window, offset in packing.round_robin(lengths, queue, target, [0.0] * 3):
        served[queue[doc]] += length
        total += length
        if total > 50_000 and total < sum(lengths) * 0.95:
            worst = max(worst, np.abs(served - total * np.array(target)).max())
    assert total == sum(lengths) and worst < 2 * 4096  # at any time each source is within two windows of its due
    first = next(packing.round_robin([10, 10], [0, 1], [0.5, 0.5], [-5000.0, 5000.0]))
    assert first[0] == 1  # what a source is owed comes first


def test_large_debts_are_paid_in_full():
    served = [0, 0]
    for doc, _, length, window, _ in packing.round_robin([500] * 2000, [k % 2 for k in range(2000)], [0.5, 0.5], [-200_000.0, 200_000.0]):
        served[doc % 2] += length
        if window == 60:
            break
    assert served[0] == 0 and served[1] > 60 * 4096


def test_windows_of_clustered_input_follow_the_targets(spark):
    rows = [(i, " ".join(rng.choice(["river", "stone", "cloud"]) for _ in range(60)), "abc"[i // 1000]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(3)
    pieces = packing.pack(docs, vocabulary()).collect()
    total, held = collections.Counter(), collections.defaultdict(collections.Counter)
    for r in pieces:
        total[r["source"]] += r["length"]
        held[r["sequence_id"]][r["source"]] += r["length"]
    full = [h for h in held.values() if sum(h.values()) == 4096]
    due = {s: n / sum(total.values()) for s, n in total.items()}
    close = [all(abs(h[s] / 4096 - due[s]) < 0.1 for s in due) for h in full]
    assert len(full) > 20 and sum(close) >= 0.8 * len(close)


def test_carries_across_partitions(spark):
    rows = [(0, 0, "a", 100), (0, 1, "b", 300), (1, 0, "a", 200), (2, 0, "b", 10), (2, 1, None, 30)]
    tokens = spark.createDataFrame(rows, "part long, pos long, source string, n long")
    total, share = 640, {"a": 300 / 640, "b": 310 / 640, None: 30 / 640}
    got = {(r["part"], q["source"]): q["deficit"] for r in packing.carries(tokens).collect() for q in r["queues"]}
    before = {0: {}, 1: {"a": 100, "b": 300}, 2: {"a": 300, "b": 300}}
    assert got == {(p, s): pytest.approx(share[s] * sum(before[p].values()) - before[p].get(s, 0)) for p, _, s, _ in rows}
    assert sum(share.values()) * total == pytest.approx(total)
    assert {q["share"] for r in packing.carries(tokens, {"a": 0.25, "b": 0.75}).collect() for q in r["queues"]} == {0.25, 0.75, 0.0}


def test_bisection():
    shares = np.array([0.7, 0.2, 0.1])
    a = mixing.bisect(shares, max_repeats=2)
    ratio = mixing.weights(shares, a) / shares
    assert ratio.max() / ratio.min() == pytest.approx(2, abs=1e-6) and 0 < a < 1
    for target in (0.85, 1.0, 1.05):
        assert mixing.entropy(mixing.weights(shares, mixing.bisect(shares, target))) == pytest.approx(target, abs=1e-6)
    assert mixing.bisect(shares, 5.0) == 0.0 and mixing.bisect(shares, max_repeats=100) == 0.0 and mixing.bisect(np.array([]), 1.0) == 1.0


@pytest.mark.parametrize("options", [{}, {"max_repeats": 5.0}, {"budget": 6000.0}, {"target_entropy": 1.2, "budget": 30000.0}])
def test_mixing(spark, options):
    rows = [(k, "w " * rng.choice([0, 3, 40]), rng.choices(["a", "b", "c", None], [60, 25, 10, 5])[0]) for k in range(3000)] + [(3, None, "a"), (None, "w w", "a")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, weight int").repartition(4)
    got = mixing.mix(docs, **options)
    assert got.columns[:4] == docs.columns
    got = got.collect()
    held = collections.Counter()
    for _, t, s in rows:
        held[s] += len((t or "").split())
    names = sorted(held, key=lambda s: "n" if s is None else "s" + s)
    found = mixing.plan(np.array([held[s] for s in names]), **options)
    drawn, longest = collections.Counter(), 42
    for r in got:
        drawn[r["source"]] += r["mix_tokens"]
    for s, full, rest, w in zip(names, found["full"], found["rest"], found["weight"]):
        due = full * held[s] + rest
        assert due - longest < drawn[s] <= due
        assert all(r["mix_weight"] == pytest.approx(w) for r in got if r["source"] == s)
    epochs = collections.Counter((r["doc_id"], r["source"], r["mix_epoch"]) for r in got)
    per_epoch = collections.Counter(r["mix_epoch"] for r in got if r["source"] == "c")
    if not options or "max_repeats" in options:
        assert {(r["doc_id"], r["source"]) for r in got} == {(i, s) for i, _, s in rows} and max(epochs.values()) <= 2
        whole = sum(s == "c" for _, _, s in rows)
        assert per_epoch[0] == whole
    key = lambda r: str((r["doc_id"], r["source"], r["mix_epoch"], r["mix_block_order"], r["mix_order"]))
    assert sorted(map(key, mixing.mix(docs.repartition(2), **options).collect())) == sorted(map(key, got))  # however it is partitioned
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_against_plain_arithmetic(spark):
    rows = [(k, "w " * rng.choice([1, 3, 40]), rng.choices("abc", [70, 25, 5])[0]) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    held = collections.Counter()
    for _, t, s in rows:
        held[s] += len(t.split())
    share = {s: n / sum(held.values()) for s, n in held.items()}
    low, high = 0.0, 1.0  # the flattest mixture that repeats no source over twice as often as another
    for _ in range(60):
        a = (low + high) / 2
        raised = {s: p**a for s, p in share.items()}
        repeats = [raised[s] / share[s] for s in share]
        low, high = (low, a) if max(repeats) <= 2 * min(repeats) else (a, high)
    weight = {s: p**high / sum(q**high for q in share.values()) for s, p in share.items()}
    budget = max(held[s] / weight[s] for s in held)
    drawn, times = collections.Counter(), collections.Counter()
    got = mixing.mix(docs).collect()
    for r in got:
        drawn[r["source"]] += len(r["text"].split())
        times[r["doc_id"]] += 1
    assert all(abs(drawn[s] - weight[s] * budget) <= 41 for s in held) and all(r["mix_weight"] == pytest.approx(weight[r["source"]], rel=1e-6) for r in got)
    assert set(times) == {i for i, _, _ in rows} and set(times.values()) <= {1, 2}
    blocks = collections.defaultdict(list)  # an epoch's order takes its blocks one by one, each in one order
    for r in sorted((r for r in got if r["source"] == "a" and r["mix_epoch"] == 0), key=lambda r: (r["mix_block_order"], r["mix_order"])):
        blocks[r["mix_block_order"]].append(r["doc_id"])
    assert len(blocks) > 200 and [i for own in blocks.values() for i in own] != sorted(i for own in blocks.values() for i in own)


def test_mixing_where_no_document_lies_before_the_cut(spark):
    order = F.xxhash64(F.lit(mixing.SEED + 1), "id")
    least = spark.range(100_000).where(F.shiftright(order, 64 - mixing.STEP) == -(1 << mixing.STEP - 1))  # hashes of the least leading bits
    docs = durable(least.select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.lit("a").alias("source")))
    n = docs.count()
    assert n > 5
    for budget, more in ((None, 0), (3 * n + 2, 0), (3 * n + 4, 1), (2, -n)):
        times = collections.Counter(r["doc_id"] for r in mixing.mix(docs, budget).collect())
        assert sum(times.values()) == n + more and (more < 0 or len(times) == n and max(times.values()) == 1 + more)


CONVERSATIONS = [
    (1, 1, "user", "hi"), (1, 2, "assistant", "a <|im_end|> b"), (1, 3, "user", "\\<|im_start|>\\"), (1, 4, "assistant", "[INST] x [/INST] </s>\\"), (1, 5, "user", "bye"),
    (2, 1, "system", None), (2, 2, "assistant", None), (3, 1, "user", ""), (4, None, "assistant", "<"), (4, 1, "as<|im_sep|>sistant", "<<SYS>>\n\n"), (None, 1, "assistant", "é😀"), (5, 1, None, "n"),
    (6, 1, "assistant", "same"), (6, 1, "assistant", "same"), (7, 2, "assistant", "<|im_sep|>"), (7, 1, "user", "<\\|im_end|>"),
]


def test_chat_reads_back(spark):
    frame = spark.createDataFrame([(*r, 1, "x") for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, example_no int, segment string").repartition(3)
    examples = chat.expand_targets(frame)
    got = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    by = collections.defaultdict(list)
    for c, turn, role, text in CONVERSATIONS:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{x[2]}\n{x[3]}\n" for x in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    full = chat.with_contexts(examples).collect()
    assert len(full) == sum(r == "assistant" for _, _, r, _ in CONVERSATIONS)
    spans = {(r["conv_id"], r["example_no"]): r for r in examples.collect()}
    for r in full:
        s = spans[r["conv_id"], r["example_no"]]
        assert len(r["context"]) == s["context_chars"] and (r["context"] + r["target"])[s["loss_start"] : s["loss_end"]] + chat.END == r["target"].partition(chat.SEP)[2]
        assert r["context"].count(chat.START) == r["context"].count(chat.END) and r["target"].count("<|") == 3
    assert chat.read_back(chat.expand_targets(frame.limit(0))).count() == 0


def test_chat_plan_is_native(spark):
    frame = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.expand_targets(frame))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def search(rows, query_ids, k, scale=256):
    whole = lambda x: int(np.floor(scale * float(np.float64(x))))
    vectors = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in vectors:
        if q in query_ids:
            score = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)[:k]
            out += [(q, n + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, i) in enumerate(score)]
    return sorted(out)


def asked(rows):
    return {i for i, _ in rows if i is not None and i % 50 == 0}


@pytest.mark.parametrize("n,dims,k,chunk", [(400, 16, 5, 1 << 25), (6, 3, 5, 1 << 25), (900, 2, 3, 100)])
def test_top_k(spark, monkeypatch, n, dims, k, chunk):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "CHUNK_BYTES", chunk)
    source = np.random.default_rng(n)
    rows = [(int(i), source.normal(0, 0.3, dims).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[1][1]) for i in range(4)]  # ties
    rows += [(2000, None), (2001, [None] * dims), (2002, [float("nan")] * dims), (2003, [float("inf")] * dims), (None, rows[0][1]), (2004, rows[0][1][: dims - 1]), (2050, []), (3000, [0.0] * dims)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, part int").repartition(3)
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), k).drop("depth").collect()
    assert sorted(map(tuple, got)) == search(rows, asked(rows), k)
    assert topk.top_k(frame, frame.limit(0), k).count() == 0 and topk.top_k(frame.limit(0), frame.where("vec_id = 0"), k).count() == 0


@pytest.mark.parametrize("size,dims", [(4e4, 3), (4e4, 300), (1e9, 300), (1e15, 40)])
def test_top_k_of_large_components(spark, monkeypatch, size, dims):
    monkeypatch.setattr(topk, "BLOCK", 32)
    source = np.random.default_rng(dims)
    rows = [(i, (source.normal(0, 1, dims) * (size if i % 3 else 1.0)).tolist()) for i in range(150)]
    rows += [(200 + i, [x + d / 256 for x, d in zip(rows[1][1], [i] + [0] * dims)]) for i in range(6)]  # apart by the last digit
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5).drop("depth").collect()
    assert sorted(map(tuple, got)) == search(rows, asked(rows), 5)


def test_top_k_keeps_vectors_beyond_any_limit(spark):
    rows = [(0, [1.0, 0.5]), (1, [40000.0, 0.5]), (2, [2.0, 0.5]), (50, [1e200, -1e200])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.where("vec_id = 0"), 2).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(50, (1 << 63) - 1), (1, 256 * 40000 * 256 + 128 * 128)]


@pytest.mark.parametrize("shape", ["skewed", "flat"])
def test_reading_stops_early_where_bounds_part(shape):
    source = np.random.default_rng(8)
    spread = 90 * 0.5 ** np.arange(12) if shape == "skewed" else np.full(12, 90.0)
    block, queries = (np.floor(source.normal(0, 1, (n, 12)) * spread) for n in (3000, 30))
    best, shares = topk.search(np.full(30, -1), queries, [(np.arange(3000), block), (np.arange(3000, 4000), block[:1000])], 5)
    for found, q in zip(best, queries):
        score = np.concatenate([block, block[:1000]]) @ q
        order = np.lexsort((np.arange(4000), -score))[:5]
        assert found == [(int(score[i]), int(i)) for i in order]
    assert shares.max() < 0.95 and shares.mean() < (0.3 if shape == "skewed" else 0.8)


def test_unseen_candidates_are_ruled_out_by_the_threshold():
    block = np.array([[x, 0.0] for x in range(1000)])
    lists = topk.Lists(np.arange(1000), block)
    left, share, paid = topk.read(np.array([2.0, 1.0]), lists, -1, 3)
    assert paid
    assert {997, 998, 999} <= set(left.tolist()) and len(left) <= 64 and share < 0.2
    assert topk.read(np.array([2.0, 1.0]), lists, -1, 3, least=1999.0)[1:] == (0.0, True)
    assert topk.read(np.array([-1.0, 0.0]), lists, 0, 1)[0].tolist()[:1] == [1]
