"""A training corpus in five stages; each stage's result is written as Parquet and reread as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quartzlog.llm import exact_dedup, mixing, packing, simhash, toxicity
from quartzlog.llm._common import durable_dir, partitions, remove, renamed
from quartzlog.llm.queries import vocabulary

#: Near duplicates share 0.8 or more of their five-word shingles, which is checked. At 0.8 texts' fingerprints differ in 15 %
#: of their bits on average: of three words (192 bits) in 29 +- 5, so up to 42 are candidates. Each of nine segments differs
#: in at most 2 bits with probability 0.36 then, some segment with 0.98 (at a similarity of 0.85 with 0.998).
NEAR = {"shingle": 5, "words": 3, "distance": 42, "reach": 2, "jaccard": 0.8}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below its threshold.

    A null text counts as empty and stays; repeated rows are judged each; rows with null id or label do not train; without
    toxic labels all stay; an empty table stays empty; other columns pass through, whatever their names.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id.

    A null text equals the empty one; a null doc_id is below all others; of repeated rows (equal doc_id and text) one stays; an
    empty table stays empty; other columns pass through.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least doc_id; of several texts of that id, one.

    Texts without words are alike, a shorter text than a shingle is one; rows of null doc_id stay; a group is what links of
    similar texts reach; an empty table stays empty; other columns pass through.
    """
    return simhash.drop_near_duplicates(docs, **NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice, at temperature-mixed weights, in the order of the mix.

    A null text has no tokens; null sources are one source; repeated rows and null ids are drawn like any other; an empty table
    stays empty; other columns pass through.
    """
    order = ["mix_epoch", "mix_block_order", "mix_order"]
    plain, names = renamed(docs)
    drawn = mixing.mix(plain, id_col=names["doc_id"], text_col=names["text"], source_col=names["source"])
    return drawn.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order).select(*names.values()).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, mixed to the sources' shares.

    A null or empty text is its end id alone; null sources are a queue of their own; repeated rows are packed each; an empty
    table gives no rows; other columns are not read.
    """
    return packing.pack(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]
#: No SQL expresses the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{durable_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        if k:
            remove(spark, f"{base}/{k - 1}-{STAGES[k - 1][0]}")  # nothing reads it any more
    return docs
