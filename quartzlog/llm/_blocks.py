"""Blocks of documents and exchanges between blocks and key buckets.

Corpus statistics over billions of n-grams do not travel as rows. A block (some MB of text) sends each bucket of
the key space one row with its distinct keys as a packed array; the bucket's owner merges the blocks' arrays and answers
each block in the order in which it asked. Whatever a key's frequency, a block sends it once, so no key makes a hot task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable, pick, raw

BLOCK_BYTES = 8 << 20
PACKED = "block long, ids binary, payload binary"


def squeeze(data, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(bytes(data))


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def put_block(ids: pa.Array, body: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    null = np.asarray(ids.is_null()).astype(np.uint8)
    return null.tobytes() + np.asarray(ids.fill_null(0)).astype("<i8").tobytes(), zstandard.ZstdCompressor(level=6).compress(np.diff(at).astype("<i8").tobytes() + body.tobytes())


def _pack(block_bytes: int):
    def run(batches):
        key = TaskContext.get().partitionId() << 24
        for batch in batches:
            body, at = raw(batch.column("text"))
            n = len(batch)
            parts = max(1, -(-len(body) // block_bytes))
            cuts = np.unique([0, n, *np.searchsorted(at, np.arange(1, parts) * len(body) // parts)])
            for a, b in zip(cuts[:-1], cuts[1:]):
                ids, payload = put_block(batch.column("doc_id").slice(a, b - a), body[at[a] : at[b]], at[a : b + 1] - at[a])
                yield pa.RecordBatch.from_pydict({"block": pa.array([key], pa.int64()), "ids": pa.array([ids], pa.binary()), "payload": pa.array([payload], pa.binary())})
                key += 1

    return run


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs as durable blocks, so that every later pass sees the same documents under the same block numbers."""
    return durable(pick(docs, id_col, text_col).mapInArrow(_pack(block_bytes), PACKED))


def unpack(ids: bytes, payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """The block's ids (None for null), bytes and n + 1 offsets."""
    n = len(ids) // 9
    null, values = np.frombuffer(ids, np.uint8, n), np.frombuffer(ids, "<i8", n, n)
    data = expand(payload)
    at = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<i8", n))]).astype(np.int64)
    return [None if x else int(v) for x, v in zip(null, values)], np.frombuffer(data, np.uint8, offset=8 * n), at


def bucket_cuts(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """For sorted keys of `bits` bits: the buckets + 1 positions at which each bucket's keys begin."""
    edges = [-(-(i << bits) // buckets) for i in range(buckets)]
    return np.concatenate([np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])


def put_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct unsigned keys, as 32-bit gaps if these suffice."""
    gaps = np.diff(keys, prepend=keys[:1])
    if len(keys) and int(gaps.max()) < 1 << 32:
        return b"g" + keys[:1].astype("<u8").tobytes() + gaps.astype("<u4").tobytes()
    return b"k" + keys.astype("<u8").tobytes()


def get_keys(data: bytes) -> np.ndarray:
    if data[:1] == b"g":
        return np.frombuffer(data, "<u8", 1, 1) + np.cumsum(np.frombuffer(data, "<u4", offset=9), dtype=np.uint64)
    return np.frombuffer(data, "<u8", offset=1)


def put_ints(values: np.ndarray) -> bytes:
    """Small non-negative integers: a byte each, larger ones aside, compressed."""
    far = np.flatnonzero(values >= 255)
    head = np.array([len(values), len(far)], "<i8").tobytes()
    return squeeze(head + np.minimum(values, 255).astype(np.uint8).tobytes() + far.astype("<i8").tobytes() + values[far].astype("<i8").tobytes())


def get_ints(data: bytes) -> np.ndarray:
    data = expand(data)
    n, far = np.frombuffer(data, "<i8", 2)
    out = np.frombuffer(data, np.uint8, n, 16).astype(np.int64)
    out[np.frombuffer(data, "<i8", far, 16 + n)] = np.frombuffer(data, "<i8", far, 16 + n + 8 * far)
    return out


def grouped(batches, key: str):
    """(key, rows as dicts) of a stream of batches sorted by key, one group in memory at a time."""
    last, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != last:
                yield last, rows
                rows = []
            last = row[key]
            rows.append(row)
    if rows:
        yield last, rows


def by_key(df: DataFrame, n: int, key: str, *then: str) -> DataFrame:
    return df.repartition(n, key).sortWithinPartitions(key, *then)


def with_replies(packed: DataFrame, replies: DataFrame, n: int) -> DataFrame:
    """Blocks and the replies to them, each block's rows together: its own row (bucket -1) first, then replies by bucket."""
    own = packed.select("block", F.lit(-1).alias("bucket"), "ids", "payload")
    theirs = replies.select("block", "bucket", F.lit(None).cast("binary").alias("ids"), "payload")
    return by_key(own.unionByName(theirs), n, "block", "bucket")
