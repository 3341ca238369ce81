"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn becomes `<|im_start|>role<|im_sep|>text<|im_end|>`. Inside roles and texts a backslash is doubled and a control
string is broken by a backslash after its first character, so no text can forge a marker and unescaping restores it.

Every assistant turn is the target of its own example and all turns before it are the context. Contexts nest, so an
example row holds only what its context adds to the previous example (`added`) and the place where the context ends
(`context_chars`); the table stays as large as the input even if one conversation holds a third of the rows.
`with_contexts` writes the contexts out in full, and `read_back` reads examples so expanded. Turns after the last reply form
a row without target.

Cases: null text or role counts as empty; turns sort by turn, then role, then text, a null turn first; repeated rows are
turns of their own; null conv_id is a conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Break `<|`, `</`, `<s`, `<<`, `[I`, `[/`, `[S` after the first character; double backslashes."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])(?=[|/sIS<])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn_no (from 1), example_no, is_target, segment."""
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    target = F.col("role") == "assistant"
    segment = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP), escape(F.col("text")), F.lit(END))
    return rows.select("conv_id", F.row_number().over(order).alias("turn_no"), F.coalesce(F.sum(target.cast("int")).over(before), F.lit(0)).alias("example_no"), target.alias("is_target"), segment.alias("segment"))


def expand_targets(conversations: DataFrame, **columns: str) -> DataFrame:
    """One row per example: conv_id, example_no, added, target, context_chars, formatted_chars, loss_start, loss_end.

    added: the formatted turns between the previous target and this one. target: the formatted reply, null in a row of
    trailing turns. The loss covers characters [loss_start, loss_end) of context + target: the reply's text alone.
    """
    turns = formatted_turns(conversations, **columns)
    parts = turns.groupBy("conv_id", "example_no").agg(F.sort_array(F.collect_list(F.struct("turn_no", "is_target", "segment"))).alias("parts"))
    joined = lambda keep: F.array_join(F.transform(F.filter("parts", keep), lambda p: p["segment"]), "")
    rows = parts.select("conv_id", "example_no", joined(lambda p: ~p["is_target"]).alias("added"), F.get(F.transform(F.filter("parts", lambda p: p["is_target"]), lambda p: p["segment"]), F.lit(0)).alias("target"))
    size = F.length("added") + F.coalesce(F.length("target"), F.lit(0))
    earlier = Window.partitionBy("conv_id").orderBy("example_no").rowsBetween(Window.unboundedPreceding, -1)
    context = F.coalesce(F.sum(size.cast("long")).over(earlier), F.lit(0)) + F.length("added")
    rows = rows.withColumn("context_chars", context.cast("long")).withColumn("formatted_chars", F.col("context_chars") + F.coalesce(F.length("target"), F.lit(0)))
    return rows.withColumn("loss_start", F.when(F.col("target").isNotNull(), F.col("context_chars") + F.instr("target", SEP) - 1 + len(SEP))).withColumn("loss_end", F.when(F.col("target").isNotNull(), F.col("formatted_chars") - len(END)))


def _whole(examples: DataFrame) -> DataFrame:
    """Each example with its context in full."""
    earlier = Window.partitionBy("conv_id").orderBy("example_no").rowsBetween(Window.unboundedPreceding, -1)
    text = F.concat("added", F.coalesce(F.col("target"), F.lit("")))
    return examples.withColumn("context", F.concat(F.array_join(F.collect_list(text).over(earlier), ""), F.col("added")))


def with_contexts(examples: DataFrame) -> DataFrame:
    """conv_id, example_no, context, target, loss_start, loss_end with each context in full: as many characters as the square
    of a conversation's."""
    return _whole(examples).where("target is not null").select("conv_id", "example_no", "context", "target", "loss_start", "loss_end")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the whole examples (context and target): n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. The loss is cut from every example's own text by its span, the turns are read from the last one's, which
    has all of them. Examples are written out and read within a task; only their losses and the last text are gathered."""
    last = F.lead("example_no").over(Window.partitionBy("conv_id").orderBy("example_no")).isNull()
    text = F.concat("context", F.coalesce(F.col("target"), F.lit("")))
    rows = _whole(examples).withColumn("last", last).select("conv_id", "example_no", F.when(F.col("last"), text).alias("text"), F.substring(text, F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")).alias("loss"))
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("example_no", "loss"))).alias("rows"), F.max("text").alias("text"))
    whole = told.select("conv_id", "text", unescape(F.array_join(F.transform("rows", lambda r: r["loss"]), "")).alias("loss"))
    marked = F.filter(F.split("text", r"\Q" + END + r"\E"), lambda s: s != "")
    part = lambda s, k: unescape(F.get(F.split(s, r"\Q" + SEP + r"\E"), F.lit(k)))
    told = F.transform(F.col("turns"), lambda s: F.concat(part(F.substring(s, len(START) + 1, 1 << 30), 0), F.lit("\n"), part(s, 1), F.lit("\n")))
    return whole.withColumn("turns", marked).select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("text").cast("long").alias("formatted_chars"))
