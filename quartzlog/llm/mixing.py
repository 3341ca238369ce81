"""Temperature mixing of sources to target weights.

A source's weight is its token share to the power a, normalised. The exponent a is found by bisection: either so that
the weights have a target entropy, or as the smallest one (the flattest mixture) under which no source is repeated more
than `max_repeats` times as often as the least repeated one. The token budget is by default the least one that draws
every document at least once, so nothing is lost; a smaller budget thins the sources that exceed it.

Budgets are realised as block permutations. A document belongs to one of BLOCKS blocks of its source by hash; an epoch
orders the blocks by another hash. Full epochs take all documents. The last, partial epoch takes whole blocks in its
order while they fit and, of the block where the budget ends, the documents of lowest hash that still fit; so a source's
tokens fall short of its budget by less than one document (rows that repeat a document stand or fall together).
Both cuts are thresholds on hashes, hence choosing a row needs nothing but the row and its source's plan.

Cases: a null text counts as empty (no tokens), null sources form a source of their own; sources without tokens are
drawn once; repeated rows and null ids are drawn like any other; an empty table gives no rows; the input's other
columns pass through `mix`, except that columns named like its own (mix_...) are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import durable, renamed

BLOCKS = 256
STEP = 12  # bits of a hash by which the cut inside a block is first found
MAX_REPEATS = 2.0
SEED = 20240229
#: Plans (a row per source) up to this many rows are broadcast; larger ones join by shuffle.
PLAN_ROWS = 50_000


def weights(shares: np.ndarray, exponent: float) -> np.ndarray:
    raised = np.where(shares > 0, np.power(np.where(shares > 0, shares, 1.0), exponent), 0.0)
    return raised / raised.sum() if raised.sum() else raised


def entropy(w: np.ndarray) -> float:
    w = w[w > 0]
    return float(-(w * np.log(w)).sum())


def bisect(shares: np.ndarray, target_entropy: float | None = None, max_repeats: float = MAX_REPEATS, low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The exponent in [low, high]. Entropy falls with it, and so does the spread of repetitions; out of reach, the nearer end."""
    some = shares[shares > 0]
    if not len(some):
        return high

    def flat_enough(a: float) -> bool:  # true from some exponent on
        if target_entropy is not None:
            return entropy(weights(some, a)) <= target_entropy
        ratio = weights(some, a) / some
        return bool(ratio.max() <= max_repeats * ratio.min() * (1 + 1e-12))

    if flat_enough(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if flat_enough(middle) else (middle, high)
    return high


def plan(tokens: np.ndarray, budget: float | None = None, target_entropy: float | None = None, max_repeats: float = MAX_REPEATS) -> dict[str, np.ndarray]:
    """Per source: weight, whole epochs and the tokens of the partial epoch."""
    tokens = tokens.astype(np.float64)
    shares = tokens / tokens.sum() if tokens.sum() else tokens
    w = weights(shares, bisect(shares, target_entropy, max_repeats))
    some = w > 0
    if budget is None:
        budget = float((tokens[some] / w[some]).max()) if some.any() else 0.0
    wanted = np.where(some, np.round(w * budget), 0)
    near = np.abs(wanted - tokens) <= 1  # a rounding step away from whole
    full = np.where(some, np.where(near, 1, wanted // np.maximum(tokens, 1)), 1)
    rest = np.where(some & ~near, wanted - full * tokens, 0)
    return {"weight": w, "full": full.astype(np.int64), "rest": rest.astype(np.int64)}


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _block_order(seed: int, epoch: Column, source: Column, block: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), source, block.cast("long"))


def _cut(inside: DataFrame, up_to) -> DataFrame:
    """(s, cut): the largest hash so that a source's documents up to it hold at most `left` tokens, null if no hash is small
    enough. First by the hashes' leading bits, then inside the piece where the tokens pass `left`; so no task sorts more than
    2**STEP pieces a source, or a 2**STEP-th of its rows."""
    pieces = inside.groupBy("s", "left", F.shiftright("o", 64 - STEP).alias("piece")).agg(F.sum("n").alias("n")).withColumn("sum", F.sum("n").over(up_to(["s"], "piece")))
    edge = pieces.where("sum > left").groupBy("s").agg(F.min_by(F.struct("piece", (F.col("left") - F.col("sum") + F.col("n")).alias("rest")), "piece").alias("e")).select("s", "e.piece", "e.rest")
    fine = inside.drop("left").join(F.broadcast(edge) if edge.count() <= PLAN_ROWS else edge, "s").where(F.shiftright("o", 64 - STEP) == F.col("piece"))
    fine = fine.groupBy("s", "rest", "o").agg(F.sum("n").alias("n")).withColumn("sum", F.sum("n").over(up_to(["s"], "o"))).where("sum <= rest").groupBy("s").agg(F.max("o").alias("o"))
    before = F.when(F.col("piece") > -(1 << STEP - 1), F.shiftleft("piece", 64 - STEP) - 1)  # nothing is below the least piece
    return edge.join(fine, "s", "left").select("s", F.coalesce("o", before).alias("cut"))


def mix(docs: DataFrame, budget: float | None = None, target_entropy: float | None = None, max_repeats: float = MAX_REPEATS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The drawn rows with all their columns, and mix_tokens, mix_weight, mix_epoch, mix_block_order, mix_order.

    Reading an epoch by (mix_block_order, mix_order) gives its permutation.
    """
    spark, given = docs.sparkSession, docs.columns
    docs, names = renamed(docs)
    id_col, text_col, source_col = (names[c] for c in (id_col, text_col, source_col))
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    order = F.xxhash64(F.lit(seed + 1), F.col(id_col).cast("long"))
    block = F.pmod(F.xxhash64(F.lit(seed + 2), F.col(id_col).cast("long")), F.lit(BLOCKS))
    narrow = docs.select(source.alias("s"), block.alias("b"), order.alias("o"), token_count(F.col(text_col)).alias("n"))
    sums = durable(narrow.groupBy("s", "b").agg(F.sum("n").alias("n")))
    totals = sums.groupBy("s").agg(F.sum("n").alias("n")).orderBy("s").collect()  # a row per source
    found = plan(np.array([r["n"] for r in totals], np.float64), budget, target_entropy, max_repeats)
    plans = spark.createDataFrame([(r["s"], float(w), int(f), int(x)) for r, w, f, x in zip(totals, *(found[k] for k in ("weight", "full", "rest")))], "s string, weight double, full long, rest long")
    hint = F.broadcast if len(totals) <= PLAN_ROWS else lambda x: x
    up_to = lambda key, by: Window.partitionBy(*key).orderBy(by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sums.join(hint(plans), "s").withColumn("p", _block_order(seed, F.col("full"), F.col("s"), F.col("b")))
    ranked = ranked.withColumn("sum", F.sum("n").over(up_to(["s"], "p")))
    edge = ranked.where("sum > rest").groupBy("s").agg(F.min_by(F.struct(F.col("p").alias("edge"), (F.col("rest") - F.col("sum") + F.col("n")).alias("left")), "p").alias("e")).select("s", "e.edge", "e.left")
    plans = durable(plans.join(edge, "s", "left"))
    inside = narrow.join(hint(plans), "s").where(_block_order(seed, F.col("full"), F.col("s"), F.col("b")) == F.col("edge"))
    cut = _cut(durable(inside.select("s", "left", "o", "n")), up_to)
    final = durable(plans.join(cut, "s", "left").select(F.col("s").alias("__s"), F.col("weight").alias("mix_weight"), F.col("full").alias("__full"), F.col("rest").alias("__rest"), F.col("edge").alias("__edge"), F.col("cut").alias("__cut")))
    rows = docs.withColumns({"__source": source, "__block": block, "mix_order": order, "mix_tokens": token_count(F.col(text_col))}).join(hint(final), F.col("__source") == F.col("__s"))
    last = _block_order(seed, F.col("__full"), F.col("__source"), F.col("__block"))
    partial = (F.col("__rest") > 0) & (F.col("__edge").isNull() | (last < F.col("__edge")) | (last == F.col("__edge")) & F.coalesce(F.col("mix_order") <= F.col("__cut"), F.lit(False)))
    copies = F.col("__full") + F.when(partial, 1).otherwise(0)
    rows = rows.withColumn("mix_epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)).otherwise(F.array().cast("array<long>"))))
    rows = rows.withColumn("mix_block_order", _block_order(seed, F.col("mix_epoch"), F.col("__source"), F.col("__block")))
    own = ("mix_tokens", "mix_weight", "mix_epoch", "mix_block_order", "mix_order")
    return rows.select(*(F.col(names[c]).alias(c) for c in given if c not in own), *own)
