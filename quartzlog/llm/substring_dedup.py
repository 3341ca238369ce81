"""Removal of long substrings that occur in an earlier document, by suffix arrays.

Every LENGTH-byte window has an anchor: the leftmost GRAM-byte string of least hash in it. Equal windows have equal anchors
at equal distances, so a window can recur in another document only if its anchor's hash does.

1. Each shard (a block of documents) tells the owners of the hash space its anchors' hashes and learns which of them
   occur in more than one document. The rest of the text cannot recur and leaves the game, exactly.
2. Over the regions around recurring anchors a shard builds a suffix array (Larsson-Sadakane refinement) and the common
   prefixes (Kasai). Neighbours with LENGTH bytes in common are one class; windows whose document is not the class's
   first are removed here, so a shard passes on each class once, however often it occurs.
3. The anchors of the classes' first windows go to their owners with the bytes around them, as sorted runs. An owner
   merges the shards' runs by binary search and finds for each window the smallest doc_id over all shards, from the
   order of the bytes after the anchor, the order of those before it, and common prefixes in both orders.
4. The answers return to the shards, which cover the windows and cut the bytes.

Nothing is judged by hash alone: hashes only decide which bytes meet. What is merged across shards are not whole suffix
arrays but the sorted contexts of recurring anchors: LENGTH bytes from the anchor on and those before it are all of a suffix
that a LENGTH-byte match can depend on, and a window without a recurring anchor has no match to find. Work in a shard and at an owner is bounded by the
block size and the number of shards' distinct classes; a string that a third of all documents share costs each shard one
context.

Cases: null text counts as empty; a null doc_id counts as smaller than all others; texts shorter than LENGTH lose
nothing; rows of equal doc_id never remove each other's bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import blocks, bucket_cuts, by_key, expand, get_keys, grouped, put_keys, squeeze, unpack, with_replies
from ._common import mix, partitions, settled
from ._suffix import anchors, common_prefixes, suffix_array, words_at

LENGTH, GRAM = 50, 24
KEY_BITS, SALT = 44, np.uint64(0xA0761D6478BD642F)
BLOCK_BYTES = 4 << 20
BLOCKS_A_BUCKET = 4  # an owner of a bucket gets about as much as this many blocks send
LOWEST = -(1 << 63)


def keyed(body: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and their keys. Anchors have the least hashes of their windows, so these are mixed again to be spread evenly."""
    place, hashed = anchors(body, at, length, gram)
    return place, mix(hashed ^ SALT) >> np.uint64(64 - KEY_BITS)


def order_ids(ids: list) -> np.ndarray:
    return np.array([LOWEST if i is None else i for i in ids], np.int64)


def _ask(buckets: int, length: int, gram: int):
    """Rows (bucket, block, keys, several): a block's distinct anchor keys and whether two of its documents have them."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, body, at = unpack(row["ids"], row["payload"])
                place, key = keyed(body, at, length, gram)
                doc = np.searchsorted(at, place, "right") - 1
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
                last = np.concatenate([first[1:], [len(key)]])[: len(first)] - 1
                several, key = doc[first] != doc[last], key[first]
                cuts = bucket_cuts(key, KEY_BITS, buckets)
                for i in range(buckets):
                    own = slice(cuts[i], cuts[i + 1])
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([i], pa.int32()), "block": pa.array([row["block"]], pa.int64()), "keys": pa.array([put_keys(key[own])], pa.binary()), "several": pa.array([np.packbits(several[own]).tobytes()], pa.binary())})

    return run


def _recurring(batches):
    """Per block and bucket a bit for each key that was asked for: it is in several blocks, or documents of one."""
    for bucket, rows in grouped(batches, "bucket"):
        keys = [get_keys(r["keys"]) for r in rows]
        every, where, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        recurs = counts > 1
        recurs[where[np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(k)) for r, k in zip(rows, keys)]) > 0]] = True
        at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        yield pa.RecordBatch.from_pydict({"block": pa.array([r["block"] for r in rows], pa.int64()), "bucket": pa.array([bucket] * len(rows), pa.int32()), "payload": pa.array([np.packbits(recurs[where[a:b]]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})


def regions(place: np.ndarray, doc: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the merged surroundings of anchors, within their documents."""
    begin = np.maximum(at[doc], place - (length - gram))
    end = np.minimum(at[doc + 1], place + length)
    new = np.concatenate([[True], (begin[1:] >= end[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    return begin[first], end[np.concatenate([first[1:], [len(place)]]) - 1]


def settle_shard(body: np.ndarray, at: np.ndarray, ids: np.ndarray, place: np.ndarray, length: int, gram: int):
    """A shard's own classes: (windows removed here, anchors to pass on, repeats, the windows that stand for them).

    Windows and anchors are positions in body; repeats are a class's further windows in its first document.
    """
    none = np.empty(0, np.int64)
    if not len(place):
        return none, none, none, none
    doc = np.searchsorted(at, place, "right") - 1
    begin, end = regions(place, doc, at, length, gram)
    size = end - begin
    ends = np.cumsum(size)
    where = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)  # positions in body of the regions' bytes
    left = np.repeat(ends, size) - np.arange(ends[-1])
    words = words_at(body[where])
    order = suffix_array(words, left, length)
    if not len(order):
        return none, none, none, none
    new = np.concatenate([[True], common_prefixes(words, order, len(where), length) < length])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(order)]]))
    owner = ids[np.searchsorted(at, where[order], "right") - 1]
    least = np.repeat(np.minimum.reduceat(owner, first), count)
    stays = owner == least
    position = where[order]
    stand_in = np.repeat(np.minimum.reduceat(np.where(stays, position, np.iinfo(np.int64).max), first), count)
    stands = position == stand_in
    marks = np.zeros(len(body) + 1, np.int64)
    marks[1:][position[stands]] = 1
    marks = np.cumsum(marks)
    low = np.maximum(at[doc], place - (length - gram))
    passed = place[marks[place + 1] > marks[low]]
    again = stays & ~stands
    return position[~stays], passed, position[again], stand_in[again]


def contexts(body: np.ndarray, at: np.ndarray, place: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the bytes around anchors (zeros outside the document), and how many are there before and from the anchor on."""
    side = length - gram
    doc = np.searchsorted(at, place, "right") - 1
    before, after = np.minimum(side, place - at[doc]), np.minimum(length, at[doc + 1] - place)
    offset = np.arange(-side, length)
    inside = (offset >= -before[:, None]) & (offset < after[:, None])
    index = np.where(inside, place[:, None] + offset, 0)
    return np.where(inside, body[index], 0).astype(np.uint8) if len(body) else np.zeros((0, side + length), np.uint8), before.astype(np.uint8), after.astype(np.uint8)


def row_strings(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as strings that sort alike; the last byte is not zero."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _shard(buckets: int, length: int, gram: int):
    """From a block and its recurring keys: a state row for the block, and a sorted run of contexts for each bucket.

    A run's row holds the contexts, both sizes (each plus one, so no string ends in zero) and doc_ids.
    """

    def run(batches):
        for block, rows in grouped(batches, "block"):
            ids, body, at = unpack(rows[0]["ids"], rows[0]["payload"])
            ids = order_ids(ids)
            place, key = keyed(body, at, length, gram)
            distinct, where = np.unique(key, return_inverse=True)
            cuts = bucket_cuts(distinct, KEY_BITS, buckets)
            bits = {r["bucket"]: r["payload"] for r in rows[1:]}
            recurs = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8), count=cuts[i + 1] - cuts[i]) for i in range(buckets)]) > 0
            chosen = recurs[where] if len(where) else np.empty(0, bool)
            gone, passed, again, stand_in = settle_shard(body, at, ids, place[chosen], length, gram)
            slot = np.searchsorted(place, passed)
            bucket = np.searchsorted(cuts[1:], where[slot], "right") if len(slot) else np.empty(0, np.int64)
            run_places, out = [], []
            for i in np.unique(bucket):
                own = passed[bucket == i]
                text, before, after = contexts(body, at, own, length, gram)
                full = np.concatenate([text, before[:, None] + 1, after[:, None] + 1], 1).astype(np.uint8)
                order = np.argsort(row_strings(full), kind="stable")
                run_places.append(own[order])
                doc = ids[np.searchsorted(at, own[order], "right") - 1]
                out.append((int(i), squeeze(full[order].tobytes(), 6), doc.astype("<i8").tobytes()))
            state = [np.packbits(_flags(gone, len(body))).tobytes(), *(np.concatenate([*x, np.empty(0, np.int64)]).astype("<u4").tobytes() for x in (run_places, [again], [stand_in]))]
            sizes = np.array([len(x) for x in state], "<i8").tobytes()
            yield _rows([(-1, block, squeeze(sizes + b"".join(state)), None), *((i, block, text, doc) for i, text, doc in out)])

    return run


RUN = "bucket int, block long, payload binary, docs binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "block", "payload", "docs"])


def _flags(places: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[places] = True
    return out


def merge_runs(runs: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """One sorted array of the runs' distinct strings, and each run's places in it; two runs at a time, by binary search."""
    level = [(r[np.concatenate([[True], r[1:] != r[:-1]])] if len(r) else r) for r in runs]
    while len(level) > 1:
        merged = []
        for a, b in zip(level[::2], level[1::2]):
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            at = np.searchsorted(a, b)
            fresh = (at == len(a)) | (a[np.minimum(at, max(0, len(a) - 1))] != b) if len(a) else np.ones(len(b), bool)
            merged.append(np.insert(a, at[fresh], b[fresh]))
        level = merged + level[len(level) & ~1 :]
    every = level[0]
    return every, [np.searchsorted(every, r) for r in runs]


def prefix_ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte rows, and for neighbours in it the length of the common prefix."""
    order = np.argsort(row_strings(np.concatenate([rows, np.ones((len(rows), 1), np.uint8)], 1)), kind="stable")
    common = np.empty(max(0, len(rows) - 1), np.int64)
    for a in range(0, len(common), 1 << 16):
        differ = rows[order[a + 1 : a + 1 + (1 << 16)]] != rows[order[a : min(a + (1 << 16), len(common))]]
        common[a : a + len(differ)] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, common


def first_docs(rows: np.ndarray, doc: np.ndarray, length: int, gram: int):
    """For each distance o of a window's begin before the anchor: per distinct context the smallest doc_id of an equal
    window among all contexts (the largest number where there is no such window)."""
    side, n = length - gram, len(rows)
    before, after = rows[:, -2].astype(np.int64) - 1, rows[:, -1].astype(np.int64) - 1
    right_order, right_common = prefix_ranks(rows[:, side : side + length])
    left_order, left_common = prefix_ranks(rows[:, :side][:, ::-1])
    right, back = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(side + 1):
        right[right_order] = np.concatenate([[0], np.cumsum(right_common < length - o)])
        back[left_order] = np.concatenate([[0], np.cumsum(left_common < o)])
        some = np.flatnonzero((before >= o) & (after >= length - o))
        out = np.full(n, np.iinfo(np.int64).max)
        if len(some):
            key = right[some] * n + back[some]
            order = np.argsort(key, kind="stable")
            key, some = key[order], some[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            out[some] = np.repeat(np.minimum.reduceat(doc[some], first), np.diff(np.concatenate([first, [len(some)]])))
        yield o, out


def _merge(length: int, gram: int):
    """Per run: for each context a bit per distance, set if an equal window is in a document of smaller id. State rows pass."""
    width = 2 * length - gram + 2

    def run(batches):
        for bucket, rows in grouped(batches, "bucket"):
            if bucket < 0:
                for r in rows:
                    yield _rows([(-1, r["block"], r["payload"], None)])
                continue
            places, runs, own = [], [], np.concatenate([np.frombuffer(r["docs"], "<i8") for r in rows])
            for r in rows:
                runs.append(row_strings(np.frombuffer(expand(r["payload"]), np.uint8).reshape(-1, width)))
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in runs])])
            every, places = merge_runs(runs)
            del runs
            place = np.concatenate(places)
            doc = np.full(len(every), np.iinfo(np.int64).max)
            np.minimum.at(doc, place, own)
            mask = np.zeros(len(place), np.uint64)
            for o, least in first_docs(np.frombuffer(every.tobytes(), np.uint8).reshape(-1, width), doc, length, gram):
                mask |= (least[place] < own).astype(np.uint64) << np.uint64(o)
            for r, a, b in zip(rows, cuts[:-1], cuts[1:]):
                yield _rows([(bucket, r["block"], squeeze(mask[a:b].astype("<u8").tobytes()), None)])

    return run


def _cut(length: int, gram: int):
    side = length - gram

    def run(batches):
        for _, rows in grouped(batches, "block"):
            own = next(r for r in rows if r["ids"] is not None)
            ids, body, at = unpack(own["ids"], own["payload"])
            state = expand(next(r for r in rows if r["ids"] is None and r["bucket"] == -1)["payload"])
            sizes, parts, p = np.frombuffer(state, "<i8", 4), [], 32
            for s in sizes:
                parts.append(state[p : p + s])
                p += s
            starts = np.unpackbits(np.frombuffer(parts[0], np.uint8), count=len(body)) > 0
            places, again, stand_in = (np.frombuffer(x, "<u4").astype(np.int64) for x in parts[1:])
            masks = np.concatenate([np.frombuffer(expand(r["payload"]), "<u8") for r in sorted((r for r in rows if r["bucket"] >= 0), key=lambda r: r["bucket"])] or [np.empty(0, np.uint64)])
            for o in range(side + 1):
                hit = places[(masks >> np.uint64(o)) & np.uint64(1) > 0]
                starts[hit - o] = True
            starts[again] |= starts[stand_in]
            change = np.zeros(len(body) + length + 1, np.int32)
            change[: len(body)] += starts
            change[length : length + len(body)] -= starts
            gone = np.cumsum(change)[: len(body)] > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            heads = at[:-1][at[:-1] < at[1:]]
            opens[heads] = gone[heads]
            spans = np.concatenate([[0], np.cumsum(opens)])
            kept = [hashlib.sha256(body[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(at[:-1], at[1:])]
            runs = _runs(gone, opens, at)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(np.diff(at)), "n_removed": pa.array(total[at[1:]] - total[at[:-1]], pa.int64()), "n_spans": pa.array(spans[at[1:]] - spans[at[:-1]], pa.int64()), "kept_sha256": pa.array(kept), "spans": runs})

    return run


def _runs(gone: np.ndarray, opens: np.ndarray, at: np.ndarray) -> pa.Array:
    """Per document its removed runs as [begin, end) byte positions of its own."""
    begin = np.flatnonzero(opens)
    closes = gone.copy()
    closes[:-1] &= ~gone[1:] | opens[1:]
    end = np.flatnonzero(closes) + 1
    doc = np.searchsorted(at, begin, "right") - 1
    pairs = pa.StructArray.from_arrays([pa.array(begin - at[doc], pa.int64()), pa.array(end - at[doc], pa.int64())], ["begin", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(at))), pa.int32()), pairs)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans for every document."""
    n = partitions(docs)
    packed = blocks(docs, id_col, text_col, BLOCK_BYTES)
    buckets = max(n, -(-packed.count() // BLOCKS_A_BUCKET))  # so a bucket's size stays the same, whatever the input
    recurring = settled(by_key(packed.mapInArrow(_ask(buckets, length, gram), "bucket int, block long, keys binary, several binary"), n, "bucket", "block").mapInArrow(_recurring, "block long, bucket int, payload binary"))
    runs = with_replies(packed, recurring, n).mapInArrow(_shard(buckets, length, gram), RUN)
    answers = by_key(runs.withColumn("to", F.when(F.col("bucket") < 0, F.xxhash64("block")).otherwise(F.col("bucket"))), n, "to", "bucket", "block").drop("to").mapInArrow(_merge(length, gram), RUN)
    return with_replies(packed, answers, n).mapInArrow(_cut(length, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>")
