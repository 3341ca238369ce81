import collections
import os
import zlib

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
pipeline = pytest.importorskip("corpus_pipeline")


def lower(t):
    return (t or "").encode().lower()


def components(prints, linked):
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if root[i] != root[j] and linked(prints[i], prints[j]):
                    a, b = sorted((root[i], root[j]))
                    root = [a if r == b else r for r in root]
                    changed = True
    return root


def test_stages_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    from quartzlog.llm import mixing, simhash, toxicity
    from quartzlog.llm.queries import vocabulary

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, frames = docs, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, kept, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        frames[name] = kept = spark.read.parquet(f"{tmp_path}/{name}")
    rows = {n: f.collect() for n, f in frames.items()}

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r["doc_id"] for r in toxicity.score_documents(docs, model).collect() if r["score"] < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in rows["toxicity"]} == clean

    last = {}
    for r in rows["toxicity"]:
        last[lower(r["text"])] = max(r["doc_id"], last.get(lower(r["text"]), -1))
    assert sorted(r["doc_id"] for r in rows["exact_dedup"]) == sorted(last.values())

    before = sorted(rows["exact_dedup"], key=lambda r: r["doc_id"])
    texts = [r["text"] or "" for r in before]
    grams, prints = [], []
    for t in texts:
        w = t.encode().lower().split()
        grams.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
        prints.append(simhash.majorities(np.unique(simhash.shingles(t.encode(), 5)), 3))
    parts = [(w, s, (1 << b) - 1) for w in range(3) for s, b in simhash.layout(3)]

    def linked(x, y):
        a, b = prints[x], prints[y]
        near = sum((p ^ q).bit_count() for p, q in zip(a, b)) <= pipeline.NEAR["distance"] and any(((a[w] ^ b[w]) >> s & m).bit_count() <= pipeline.NEAR["reach"] for w, s, m in parts)
        return near and len(grams[x] & grams[y]) >= 0.8 * len(grams[x] | grams[y])

    root = components(range(len(before)), linked)
    assert sorted(r["doc_id"] for r in rows["near_dedup"]) == [r["doc_id"] for k, r in enumerate(before) if root[k] == k]

    held = collections.Counter()
    for r in rows["near_dedup"]:
        held[r["source"]] += len((r["text"] or "").encode().split())
    names = sorted(held, key=lambda s: "n" if s is None else "s" + s)
    plan = mixing.plan(np.array([held[s] for s in names]))
    drawn = collections.Counter()
    for r in rows["mixing"]:
        drawn[r["source"]] += len((r["text"] or "").encode().split())
    longest = max(len((r["text"] or "").encode().split()) for r in rows["near_dedup"])
    for s, full, rest in zip(names, plan["full"], plan["rest"]):
        assert full * held[s] + rest - longest < drawn[s] <= full * held[s] + rest
    copies = collections.Counter(r["doc_id"] for r in rows["mixing"])
    assert set(copies) == {r["doc_id"] for r in rows["near_dedup"]} and max(copies.values()) <= 2

    whole = Tokenizer.from_file(vocabulary())
    text = {r["doc_id"]: r["text"] for r in rows["mixing"]}
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in text.items()}
    covered = collections.defaultdict(collections.Counter)
    for r in rows["packing"]:
        own = ids[r["doc_id"]]
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        covered[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
    assert all(covered[i] == {k: copies[i] for k in range(len(ids[i]))} for i in ids)


def test_run(spark):
    frame = pipeline.run(spark, SF)
    assert frame.columns[:3] == ["doc_id", "start", "length"] and frame.count() > 0
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_mixed_rows_stand_in_the_order_of_the_mix(spark, tmp_path):
    from quartzlog.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["doc_id"])
    order = ["mix_epoch", "mix_block_order", "mix_order", "doc_id"]
    want = [r["doc_id"] for r in mixing.mix(docs).orderBy(*order).collect()]
    got = [r["doc_id"] for r in pipeline.mix_sources(spark, docs, SF).collect()]
    assert got == want


def test_stages_take_odd_rows(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(None, None, "a"), (None, text, None), (1, "", "a"), (2, " \t", "a"), (3, text, "b"), (3, text, "b"), (4, text.upper(), "b"), (5, text + " more", "b"), (5, "other words here", None), (6, "x" * 200_000, "c"), (7, "y " * 60_000, "c")]
    kind = "doc_id long, text string, source string, __id long, n long, score double, root string, rows long, fp long, mix_epoch long, part long"
    for given in (rows, []):
        docs = spark.createDataFrame([(*r, 1, 2, 0.5, "r", 3, 4, 5, 6) for r in given], kind).coalesce(2)
        counts = []
        for k, (name, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{len(given)}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{len(given)}-{k}")
            counts.append(docs.count())
        if given:
            assert counts[:3] == [11, 7, 5]
        assert bool(counts[-1]) == bool(given)
