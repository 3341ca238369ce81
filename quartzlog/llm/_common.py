"""Helpers that the operators share: durable cuts of lineage, raw text access, vectorised word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whitespace of the contracts: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are no ASCII letter or digit and no part of a longer UTF-8 character.
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
R = np.uint64(0x9E3779B97F4A7C15 | 5)
R_INV = np.uint64(pow(int(R), -1, 1 << 64))
KEYS = np.array([0x2D358DCCAA6C78A5, 0x8BB84B93962EACC9, 0x4B33A62ED433D4A3, 0x4D5A2DA51DE1AA47], np.uint64)
SEED = 0x5AFE
HOT = 1000
_powers = {}


def durable_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage; a temporary folder only where none is configured and all is one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that the session knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint df (eagerly) in the shared folder."""
    durable_dir(df.sparkSession)
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """durable, and ask the driver's JVM to collect its garbage now: shuffle files that led to df can go before the next
    step writes its own."""
    out = durable(df)
    del df
    gc.collect()
    out.sparkSession._jvm.System.gc()
    return out


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows joined with their group's row. groups has distinct keys and `rows`, how many of the `total` rows a group has.

    At most HOT groups can have over total / HOT rows; theirs are joined by a broadcast, in place. All others are small
    enough for one task each. The column `rows` goes.
    """
    least = max(HOT, total // HOT)
    large = F.broadcast(groups.where(F.col("rows") > least).drop("rows"))
    rest = rows.join(large.select(*keys), keys, "left_anti").join(groups.where(F.col("rows") <= least).drop("rows"), keys)
    return rows.join(large, keys).unionByName(rest)


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ..., which clash with no helper column, and the new name of each."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int):
    """(first, last) rows so that each run of rows holds about `most` bytes; a longer text stands alone."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n."""
    if _powers.get("n", 0) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            up, down = np.full(size, R, np.uint64), np.full(size, R_INV, np.uint64)
            up[0] = down[0] = 1
            _powers.update(n=size, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def span_hashes(body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of substrings, each of its own bytes alone. Up to 16 bytes are two numbers, mixed; longer ones take
    XXH3 with a seed."""
    size = end - begin
    if not len(size):
        return np.empty(0, np.uint64)
    shown = np.lib.stride_tricks.sliding_window_view(np.concatenate([body, np.zeros(16, np.uint8)]), 16)[begin]
    shown = (shown * (np.arange(16) < size[:, None])).view("<u8")
    with np.errstate(over="ignore"):
        out = mix(mix(mix(shown[:, 0] + KEYS[0]) ^ (shown[:, 1] * KEYS[1] + KEYS[2])) + size.astype(np.uint64) * KEYS[3])
    far = np.flatnonzero(size > 16)
    if len(far):
        data = memoryview(np.ascontiguousarray(body))
        out[far] = [xxhash.xxh3_64_intdigest(data[a:b], SEED) for a, b in zip(begin[far].tolist(), end[far].tolist())]
    return out


def prefix_hash(body: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums of (byte + 1) * R**i: a hash of any substring follows from two of them. Equal substrings have equal
    hashes; long patterned ones may collide, so these only decide which bytes are compared."""
    up, _ = powers(max(1, len(body)))
    out = np.zeros(len(body) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[: len(body)], out=out[1:])
    return out


def word_spans(body: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word: a run of bytes not in `gap`; a word ends with its text."""
    word = ~gap[body]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(body))]
    begins[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[inner - 1] = word[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(body: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts (A-Z lower-cased), in order, and each text's number of words."""
    if not len(body):
        return np.empty(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    body = LOWER[body]
    begin, end = word_spans(body, at, gap)
    return span_hashes(body, begin, end), np.diff(np.searchsorted(begin, at))


def crc_mod(ids: pa.Array, modulus: int) -> np.ndarray:
    """crc32 of each id as decimal text, modulo; a null id counts as empty text."""
    return np.fromiter((zlib.crc32(b"" if i is None else b"%d" % i) % modulus for i in ids.to_pylist()), np.int64, len(ids))


def give_back() -> None:
    """Return freed memory to the system; Python workers live on after a task and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, left_out: int, bound: int) -> DataFrame:
    """doc_id, text, label of at most `bound` labelled training rows: those of lowest hashed id, so at most `bound` ids are broadcast.

    A row trains if its id and 0/1 label are not null and crc32(id as text) mod modulus is not left_out; of several
    labels for an id the largest counts, and of several rows with an id the greatest text.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    ids = ids.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != left_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
