import hashlib
import random

import numpy as np
import pytest
import xxhash

from quartzlog.llm import exact_dedup, simhash, substring_dedup

DOCS = "doc_id long, text string, kept string, rid long, w0 long, lang string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "k", 1, 2, None) for i, t in rows], DOCS).repartition(parts)


def random_text(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [random_text(rng, rng.choice([0, 1, 3, 20, 200, 900])) for _ in range(40)]
    passage = random_text(rng, 30)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 12].upper() if i % 3 else base[i % 12]) for i in range(40)]  # copies, some by case only
    rows += [(200 + i, random_text(rng, 15) + " " + passage[: rng.randint(40, len(passage))] + " " + random_text(rng, 9)) for i in range(30)]
    near = random_text(rng, 300).split()
    for i in range(25):
        own = list(near)
        own[rng.randrange(300)] = "changed"
        rows.append((300 + i, " ".join(own)))
    rows += [(None, None), (None, base[5]), (7, base[7]), (7, base[7]), (400, "é" * 60), (401, "x é" * 30), (402, "é" * 61), (403, ""), (404, " \t\n"), (405, "a b"), (406, "A  b")]
    return rows


def exact_expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_exact_duplicates(spark, corpus, block):
    got = exact_dedup.exact_duplicates(frame(spark, corpus), block_bytes=block).collect()
    want = exact_expected(corpus)
    by_sha = {hashlib.sha256(k).hexdigest(): v for k, v in want.items()}
    assert len(got) == len(corpus)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_sha[r["text_sha256"]]
    assert sum(r["kept"] for r in got) == len(want)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_exact_duplicates(spark, corpus):
    kept = exact_dedup.drop_exact_duplicates(frame(spark, corpus))
    assert kept.columns == ["doc_id", "text", "kept", "rid", "w0", "lang"]
    rows = kept.collect()
    want = exact_expected(corpus)
    assert sorted(str((r["text"] or "").encode().lower()) for r in rows) == sorted(map(str, want))
    assert all(r["doc_id"] == want[(r["text"] or "").encode().lower()][0] for r in rows)


def plain_fingerprint(text, k=4):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def union(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return find


@pytest.mark.parametrize("distance", [0, 2, 4, 7])
def test_near_duplicates(spark, corpus, distance):
    got = simhash.near_duplicates(frame(spark, corpus), distance=distance).collect()
    assert len(got) == len(corpus)
    prints = sorted({plain_fingerprint(t or "") for _, t in corpus})
    find = union(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance])
    least = {}
    for i, t in corpus:
        if i is not None:
            r = find(plain_fingerprint(t or ""))
            least[r] = min(least.get(r, i), i)
    want = sorted(str((i, f"{plain_fingerprint(t or ''):016x}", least.get(find(plain_fingerprint(t or ""))))) for i, t in corpus)
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got) == want


@pytest.mark.parametrize("segments,distance", [(2, 4), (3, 4), (4, 4), (2, 7)])
def test_links_find_every_pair(spark, segments, distance):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    flips = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)) for b in base for k in (1, 3, 4, 5, 8)]
    prints = sorted({int(b) for b in base} | set(flips) | {0, 1})
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    pairs = simhash.links(spark.createDataFrame([(s, s) for s in signed], "fp long, w0 long"), distance, segments=segments).collect()
    got = union(signed, [(r["a"], r["b"]) for r in pairs])
    want = union(signed, [(x, y) for x, p in zip(signed, prints) for y, q in zip(signed, prints) if x < y and (p ^ q).bit_count() <= distance])
    assert [got(s) for s in signed] == [want(s) for s in signed]


def test_links_of_a_given_reach_do_not_depend_on_size(spark, monkeypatch):
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        own = [rng.getrandbits(64) for _ in range(3)]
        other = list(own)
        for bit in rng.sample(range(192), 30):
            other[bit // 64] ^= 1 << bit % 64
        prints += [own, other]
    rows = [(k, *(x - (1 << 64) if x >> 63 else x for x in p)) for k, p in enumerate(prints)]
    distinct = spark.createDataFrame(rows, "fp long, w0 long, w1 long, w2 long")
    found = lambda: {(r["a"], r["b"]) for r in simhash.links(distinct, 34, 3, 1).collect()}
    few = found()
    monkeypatch.setattr(type(distinct), "count", lambda self: 1 << 23)
    assert found() == few and few


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_components_of_long_chains(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "ONE_TASK", most)
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 102), (101, 103), (-5, -9)]
    got = {r["a"]: r["b"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100, 103: 100, -5: -9}


def test_drop_near_duplicates(spark, corpus):
    kept = simhash.drop_near_duplicates(frame(spark, corpus), shingle=5, words=3, distance=34, reach=1)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sum(i is not None and 300 <= i < 400 for i in ids) == 1 and ids.count(None) == 2
    assert all(i in ids for i in range(200, 230)) and kept.columns[:2] == ["doc_id", "text"]


def shingle_sets(texts, k=5):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def set_prints(texts, words=3):
    return [simhash.majorities(np.unique(simhash.shingles((t or "").encode(), 5)), words) for t in texts]


def candidates(a, b, distance, reach):
    parts = [(w, s, (1 << n) - 1) for w in range(len(a)) for s, n in simhash.layout(3)]
    return sum((x ^ y).bit_count() for x, y in zip(a, b)) <= distance and any(((a[w] ^ b[w]) >> s & m).bit_count() <= reach for w, s, m in parts)


def edited(rng, words, changes):
    own = list(words)
    for at in rng.sample(range(len(own)), changes):
        own[at] = random_text(rng, 1) + "z"
    return " ".join(own)


@pytest.mark.parametrize("wide,tries", [(64, 4), (2, 1)])
def test_pipeline_near_copies_against_all_pairs(spark, monkeypatch, wide, tries):
    import corpus_pipeline

    monkeypatch.setattr(simhash, "WIDE", wide)
    monkeypatch.setattr(simhash, "TRIES", tries)
    monkeypatch.setattr(simhash, "HELD", 50)
    rng = random.Random(11)
    texts = []
    for _ in range(40):
        near = random_text(rng, 300).split()
        texts += [edited(rng, near, rng.choice([2, 5, 8, 11])) for _ in range(5)]
    star = random_text(rng, 300).split()  # one large group: members are alike through the first one only
    texts += [" ".join(star)] + [edited(rng, star, 6) for _ in range(60)]
    texts += [edited(rng, star, 14) for _ in range(20)]  # and some that are candidates but not similar
    texts += ["", " ", "a b", "A  b", "a c", "x " * 50, "x " * 60, "X " * 70]
    sets, prints = shingle_sets(texts), set_prints(texts)
    near, options = corpus_pipeline.NEAR, range(len(texts))
    find = union(options, [(a, b) for a in options for b in range(a + 1, len(texts)) if candidates(prints[a], prints[b], near["distance"], near["reach"]) and similarity(sets[a], sets[b]) >= near["jaccard"]])
    got = simhash.drop_near_duplicates(frame(spark, list(enumerate(texts))), **near).collect()
    assert sorted(r["doc_id"] for r in got) == [k for k in options if find(k) == k]


def test_candidates_of_similar_texts_are_found():
    import corpus_pipeline

    rng, near = random.Random(4), corpus_pipeline.NEAR
    found = {}
    while min((len(x) for x in found.values()), default=0) < 150 or len(found) < 4:
        words = random_text(rng, rng.choice([60, 150, 400])).split()
        a, b = " ".join(words), edited(rng, words, rng.randint(1, max(1, len(words) // 40)))
        x, y = shingle_sets([a, b])
        j = similarity(x, y)
        if j >= 0.8:
            found.setdefault(int(j * 20), []).append(candidates(*set_prints([a, b]), near["distance"], near["reach"]))
    share = {k / 20: sum(x) / len(x) for k, x in sorted(found.items()) if k < 20}
    assert share[0.8] >= 0.96 and share[0.85] >= 0.99 and share[0.9] >= 0.99 and share[0.95] >= 0.99, share


@pytest.mark.parametrize("jaccard", [None, 0.8])
def test_drop_near_duplicates_of_repeated_ids(spark, jaccard):
    rng = random.Random(2)
    near, clean, twin = (random_text(rng, 300) for _ in range(3))
    rows = [(1, near), (2, near + " more"), (2, clean), (3, twin), (3, twin + " more"), (4, twin + " most")]
    got = simhash.drop_near_duplicates(frame(spark, rows), shingle=5, words=3, distance=42, reach=2, jaccard=jaccard).collect()
    kept = sorted((r["doc_id"], r["text"]) for r in got)
    assert kept[0] == (1, near) and kept[1] == (2, clean) and [i for i, _ in kept] == [1, 2, 3]


def substring_expected(rows, length):
    low = -(1 << 63)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, 1 << 62), low if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < (low if i is None else i):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append(str((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())))
    return sorted(out)


@pytest.mark.parametrize("length,gram,block", [(50, 24, 1 << 22), (50, 24, 3000), (20, 8, 500)])
def test_repeated_spans(spark, corpus, monkeypatch, length, gram, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    rows = [*corpus, (500, "ab" * 300), (501, "ab" * 40 + "c" + "ab" * 60), (502, "z" * 49), (503, "z" * 50), (504, "z" * 200), (-3, "z" * 55)]
    got = substring_dedup.repeated_spans(frame(spark, rows), length=length, gram=gram).collect()
    assert sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == substring_expected(rows, length)
    assert all(sum(e - b for b, e in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"] for r in got)


def test_empty_tables(spark):
    empty = frame(spark, [], 1)
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and substring_dedup.repeated_spans(empty).count() == 0


def test_anchors_are_told_by_whole_hashes(monkeypatch):
    from quartzlog.llm import _suffix
    from quartzlog.llm._common import mix

    monkeypatch.setattr(_suffix, "mix", lambda x: mix(x) & np.uint64(0xFFFF))  # all upper bits are equal
    rng = np.random.default_rng(6)
    text = rng.integers(97, 123, 1 << 20).astype(np.uint8)
    place, hashed = _suffix.anchors(text, np.array([0, len(text)]), 50, 24)
    _, every = _suffix.anchors(text, np.array([0, len(text)]), 24, 24)
    windows = np.lib.stride_tricks.sliding_window_view(every, 27)
    assert place.tolist() == np.unique(np.arange(len(windows)) + windows.argmin(1)).tolist() and hashed.tolist() == every[place].tolist()
    for a in (0, 1000, 400_000):
        part = text[a : a + 50]
        alone, _ = _suffix.anchors(part, np.array([0, 50]), 50, 24)
        assert alone[0] + a in set(place.tolist())


def test_keys_of_anchors_are_spread_evenly():
    text = np.random.default_rng(7).integers(97, 123, 1 << 20).astype(np.uint8)
    _, key = substring_dedup.keyed(text, np.array([0, len(text)]), 50, 24)
    held = np.bincount((np.unique(key) >> np.uint64(substring_dedup.KEY_BITS - 6)).astype(np.int64), minlength=64)
    assert held.max() < 1.2 * held.mean()


def test_a_long_text_and_a_short_one_agree(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghijkl ") for _ in range(1_200_000))
    rows = [(1, long), *((k, long[at : at + 50]) for k, at in enumerate(range(3, 1_199_000, 60_007), 2)), (99, long[77:1077])]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_spans(frame(spark, rows)).collect()}
    assert all(got[i]["n_removed"] == got[i]["n_bytes"] for i, _ in rows[1:]) and got[1]["n_removed"] == 0


def test_groups_are_joined_whole_whatever_their_size(spark, monkeypatch):
    from quartzlog.llm import _common

    monkeypatch.setattr(_common, "HOT", 10)
    rows = spark.createDataFrame([(k % 40 if k % 3 else 7, k) for k in range(900)], "g long, k long").repartition(3)
    groups = rows.groupBy("g").count().selectExpr("g", "g * 2 as twice", "count as rows")
    got = _common.join_groups(rows, groups, ["g"], 900)
    assert sorted(map(tuple, got.collect())) == sorted((k % 40 if k % 3 else 7, k, 2 * (k % 40 if k % 3 else 7)) for k in range(900)) and got.columns == ["g", "k", "twice"]


def test_pairs_are_ruled_out_only_if_they_cannot_be_similar():
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (0, 1, 40, 150, 150, 3000, 70_000)]
    sets += [np.unique(np.concatenate([s[len(s) // 9 :], rng.integers(0, 1 << 62, len(s) // 12).astype(np.uint64)])) for s in sets]
    sets = [np.unique(s) for s in sets]
    counts, size = np.array([simhash.lanes(s) for s in sets]), np.array([len(s) for s in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    able = simhash.can_be_similar(counts, size, a, b, 0.8)
    alike = np.array([len(np.intersect1d(sets[x], sets[y])) / max(1, len(np.union1d(sets[x], sets[y]))) if size[x] + size[y] else 1.0 for x, y in zip(a, b)])
    assert able[alike >= 0.8].all() and not able[(alike < 0.2) & (size[a] + size[b] < 400)].any()
