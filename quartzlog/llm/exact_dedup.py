"""Exact dedup by deterministic block naming.

Every text (A-Z lower-cased, UTF-8) is cut into fixed-size blocks. Distinct blocks are sorted and numbered, so that a
block's integer name stands for its bytes without collisions; then adjacent names are paired, distinct pairs are sorted
and numbered, and so on until each document has one name. Two documents with as many blocks are equal iff their last
names are equal.

Cases: a null text counts as empty; empty texts equal each other; a null doc_id sorts below every other; of repeated
rows (equal doc_id and text) one stays; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable, give_back, join_groups, partitions, pick, raw, renamed

BLOCK_BYTES = 4096
CUT = "rid long, doc_id long, sha binary, n_blocks int, pos int, batch long, lid int, route long, block binary"
NAMED = "rid long, doc_id long, sha binary, n_blocks int, pos int, batch long, lid int, name long"


def _cut(block_bytes: int):
    """Rows of two kinds: each block's place (pos set), and each distinct block of an Arrow batch once (block set).

    A block that a third of the corpus shares so leaves each batch once only. It travels in zstd form, which is a
    function of its bytes and back, so equality and an order of the forms are those of blocks.
    """
    fields = ["rid", "doc_id", "sha", "n_blocks", "pos", "batch", "lid", "route", "block"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1, write_content_size=False, write_checksum=False)
        base, seen, number = TaskContext.get().partitionId() << 40, 0, 0
        for batch in batches:
            body, at = raw(batch.column("text"))
            body, key = body.tobytes(), base + number
            number += 1
            names: dict[bytes, int] = {}
            places: list[tuple] = []
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = body[at[k] : at[k + 1]].lower()  # of bytes: A-Z only
                sha, n = hashlib.sha256(text).digest(), max(1, -(-len(text) // block_bytes))
                for i in range(n):
                    lid = names.setdefault(text[i * block_bytes : (i + 1) * block_bytes], len(names))
                    places.append((base + seen, doc_id, sha if not i else None, n, i, key, lid, None, None))
                seen += 1
            forms = [packer.compress(x) for x in names]
            for lid, x in enumerate(forms):
                places.append((None, None, None, None, None, key, lid, xxhash.xxh64_intdigest(x) - (1 << 63), x))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*places), kinds)] if places else [pa.array([], t) for t in kinds], fields)
            del body, names, places, forms
        give_back()

    return run


def _number(batches):
    """Within a partition sorted by block: the same number for equal blocks, the next one for the next block."""
    base, last, rank = TaskContext.get().partitionId() << 40, None, -1
    for batch in batches:
        names = []
        for block, pos in zip(batch.column("block").to_pylist(), batch.column("pos").to_pylist()):
            if pos is not None:
                names.append(None)
                continue
            if rank < 0 or block != last:
                last, rank = block, rank + 1
            names.append(base + rank)
        keep = [batch.column(c) for c in ("rid", "doc_id", "sha", "n_blocks", "pos", "batch", "lid")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(names, pa.int64())], ["rid", "doc_id", "sha", "n_blocks", "pos", "batch", "lid", "name"])


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: rid (a row number), doc_id, text_sha256, n_blocks, name; equal texts have equal (n_blocks, name)."""
    n = partitions(docs)
    cut = pick(docs, id_col, text_col).mapInArrow(_cut(block_bytes), CUT)
    dealt = cut.repartition(n, F.coalesce(F.col("route"), F.xxhash64("batch", "lid"))).sortWithinPartitions("block")
    named = durable(dealt.mapInArrow(_number, NAMED))
    places, blocks = named.where("pos is not null").drop("name"), named.where("pos is null").select("batch", "lid", "name")
    state = durable(places.join(blocks, ["batch", "lid"]).select("rid", "pos", "n_blocks", "name"))
    most = state.agg(F.max("n_blocks")).first()[0] or 1
    done = state.where("n_blocks = 1").select("rid", "name")
    rest = state.where("n_blocks > 1").select("rid", "pos", "name")
    while most > 1:
        even = F.col("pos") % 2 == 0
        pairs = rest.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = durable(pairs)
        numbers = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows")).repartition(n, "a", "b").sortWithinPartitions("a", "b")
        numbers = durable(numbers.withColumn("name", F.monotonically_increasing_id()))
        rest = durable(join_groups(pairs, numbers, ["a", "b"], pairs.count()).select("rid", "pos", "name"))
        most = -(-most // 2)
    heads = places.where("pos = 0").select("rid", "doc_id", "n_blocks", F.lower(F.hex("sha")).alias("text_sha256"))
    return heads.join(done.unionByName(rest.select("rid", "name")), "rid")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the row with the largest doc_id stays."""
    rows = durable(identities(docs, id_col, text_col, block_bytes))
    best = F.max(F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), -F.col("rid"))).alias("best")
    groups = rows.groupBy("n_blocks", "name").agg(best, F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("n_blocks", "name", "group_size", F.col("group_size").alias("rows"), F.col("best.doc_id").alias("keep_id"), (-F.col("best.col3")).alias("keep_rid"))
    return join_groups(rows, groups, ["n_blocks", "name"], rows.count()).select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain, names = renamed(docs)
    sha = F.sha2(F.translate(F.coalesce(F.col(names[text_col]), F.lit("")), upper, upper.lower()), 256)
    keyed = plain.withColumns({"__id": F.col(names[id_col]).cast("long"), "__sha": sha})
    joined = keyed.join(kept, F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__sha") == F.col("__kept_sha")), "left_semi")
    return joined.dropDuplicates(["__id", "__sha"]).drop("__id", "__sha").toDF(*docs.columns)
