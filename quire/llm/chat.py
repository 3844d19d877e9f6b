"""Chat formatting by prefix-target expansion, in DataFrame expressions only.

Every assistant turn becomes an example of its own: all preceding turns are its
context, and only the reply's text is trainable. ``expanded`` writes the examples out,
context and reply, with the span of the loss mask, and what follows the last reply as
a rest. A conversation of n turns has up to n/2 examples whose contexts overlap, so
this takes space in the square of n. ``examples`` is the exact form for conversations
too long for that: each rendered turn once (``segments``), the context by position.
``digests`` reads all back from the expanded texts, and from the positional form where
expansion would pass ``EXPANDED`` code points.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles, one
backslash is put between ``<`` and ``|`` of every ``<\\...\\|`` (any number of
backslashes), so no control string can occur in them; taking one away restores
the text. A role's ``%`` and newline become ``%25`` and ``%0A``, so that the
first newline of a segment ends its role.

Defined cases. Null text or role: empty. Null turn: before all others. Rows of
equal turn: by role, then text, as rendered. Repeated rows: each is a turn. Null conv_id: one
conversation. A conversation without assistant turns has segments and no
example. Other columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
EXPANDED = 1 << 25  # code points that a conversation's examples may have together


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, segment (rendered), is_target, and the span of
    the turn's text in the segment (loss_start, loss_end, in code points). No shuffle."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(START), _role_out(role), F.lit("\n"))
    body = escape(text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        (role == TARGET_ROLE).alias("is_target"),
        F.length(head).cast("long").alias("loss_start"),
        (F.length(head) + F.length(body)).cast("long").alias("loss_end"),
    )


def parsed(segs: DataFrame) -> DataFrame:
    """Role and text read back from the rendered segments."""
    inner = F.expr(f"substring(segment, {len(START) + 1}, length(segment) - {len(START) + len(END) + 1})")
    return (
        segs.withColumn("_inner", inner)
        .withColumn("_role", _role_in(F.expr("substring(_inner, 1, instr(_inner, '\n') - 1)")))
        .withColumn("_text", unescape(F.expr("substring(_inner, instr(_inner, '\n') + 1)")))
        .drop("_inner")
    )


def examples(segs: DataFrame, block: int = 1024) -> DataFrame:
    """One row per assistant turn: conv_id, turn, context_turns, context_chars, target
    (the rendered reply), loss_start and loss_end in context + target.

    Prefix sums are taken in two levels, over blocks of ``block`` turn numbers and
    within a block, so that a very long conversation is dealt over many tasks.
    """
    from pyspark.sql import Window as W

    s = segs.withColumn("_b", F.floor(F.col("turn") / block)).withColumn("_n", F.length("segment").cast("long"))
    sums = s.groupBy("conv_id", "_b").agg(F.sum("_n").alias("_c"), F.count(F.lit(1)).alias("_k"))
    before = W.partitionBy("conv_id").orderBy(F.col("_b").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("_conv"),
        F.col("_b").alias("_block"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0"),
        F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_k0"),
    )
    inside = (
        W.partitionBy("conv_id", "_b")
        .orderBy(F.col("turn").asc_nulls_first(), "segment")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    joined = s.withColumn("_c1", F.coalesce(F.sum("_n").over(inside), F.lit(0))).withColumn(
        "_k1", F.count(F.lit(1)).over(inside)
    )
    joined = joined.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_b").eqNullSafe(F.col("_block")))
    chars = F.col("_c0") + F.col("_c1")
    return joined.filter("is_target").select(
        "conv_id",
        "turn",
        (F.col("_k0") + F.col("_k1")).alias("context_turns"),
        chars.alias("context_chars"),
        F.col("segment").alias("target"),
        (chars + F.col("loss_start")).alias("loss_start"),
        (chars + F.col("loss_end")).alias("loss_end"),
    )


def expanded(segs: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end: every example in full, numbered from 1 in order of
    turns, the loss mask as a span of ``text``; and one row more per conversation, without a span: the
    rest behind its last reply."""
    seg = F.struct("turn", "segment", "is_target", "loss_start", "loss_end")
    per = segs.groupBy("conv_id").agg(F.array_sort(F.collect_list(seg)).alias("s"))
    at = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.col("s")[i]["is_target"])
    per = per.withColumn("at", at).withColumn("ends", F.concat("at", F.array(F.size("s"))))
    ex = per.select("conv_id", "s", F.coalesce(F.try_element_at("at", F.lit(-1)), F.lit(-1)).alias("last"), F.posexplode("ends").alias("n", "i"))
    rest = F.col("i") == F.size("s")
    texts = lambda start, length: F.array_join(F.transform(F.slice("s", start, length), lambda x: x["segment"]), "")
    hit = F.try_element_at("s", F.col("i") + 1)  # null for the rest
    ex = ex.withColumn("_p", F.when(rest, texts(F.col("last") + 2, F.size("s"))).otherwise(texts(F.lit(1), F.col("i"))))
    return ex.select(
        "conv_id",
        (F.col("n") + 1).alias("example"),
        F.concat("_p", F.coalesce(hit["segment"], F.lit(""))).alias("text"),
        (F.length("_p") + hit["loss_start"]).alias("loss_start"),
        (F.length("_p") + hit["loss_end"]).alias("loss_end"),
    )


def materialize(segs: DataFrame) -> DataFrame:
    """The examples with full texts: conv_id, example (from 1), text, loss_start, loss_end."""
    return expanded(segs).filter("loss_start IS NOT NULL")


def _digested(conv_id: str, n_turns: Column, turns: Column, loss: Column, formatted: Column) -> list[Column]:
    return [
        F.col(conv_id).alias("conv_id"),
        n_turns.cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        formatted.cast("long").alias("formatted_chars"),
    ]


def _from_expanded(segs: DataFrame) -> DataFrame:
    """Turns from the last example's text and the rest, trainable texts from the span of every example."""
    mask = F.expr("substring(text, cast(loss_start + 1 as int), cast(loss_end - loss_start as int))")
    rest = F.col("loss_start").isNull()
    read = expanded(segs).select("conv_id", "example", "text", rest.alias("rest"), unescape(mask).alias("m"))
    per = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(~F.col("rest"), F.struct("example", "m")))).alias("ms"),
        F.max_by("text", F.when(~F.col("rest"), F.col("example"))).alias("last"),
        F.max(F.when(F.col("rest"), F.col("text"))).alias("rest"),
    )
    per = per.select("conv_id", F.array_join(F.transform("ms", lambda x: x["m"]), "").alias("loss"), F.concat(F.coalesce("last", F.lit("")), "rest").alias("all"))
    # control strings are nowhere inside a turn: its end cuts the text, and its first newline ends the role
    turns = F.filter(F.split("all", END.replace("|", r"\|") + "\n"), lambda x: x != "")
    turns = F.transform(turns, lambda x: F.substr(x, F.lit(len(START) + 1)))
    per = per.withColumn("turns", F.transform(turns, _turn))
    return per.select(*_digested("conv_id", F.size("turns"), F.array_join("turns", ""), F.col("loss"), F.length("all")))


def _turn(inner: Column) -> Column:
    cut = F.instr(inner, "\n")
    return F.concat(_role_in(F.substr(inner, F.lit(1), cut - 1)), F.lit("\n"), unescape(F.substr(inner, cut + 1)), F.lit("\n"))


def _from_positions(segs: DataFrame) -> DataFrame:
    """The same, from the segments and from the examples that name their contexts."""
    p = parsed(segs).select("conv_id", F.length("segment").cast("long").alias("n"), F.struct("turn", "segment", F.col("_role").alias("r"), F.col("_text").alias("t")).alias("x"))
    per = p.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("x")).alias("xs"), F.count(F.lit(1)).alias("n_turns"), F.sum("n").alias("formatted_chars")
    )
    turns = F.array_join(F.transform("xs", lambda x: F.concat(x["r"], F.lit("\n"), x["t"], F.lit("\n"))), "")
    reply = F.expr("substring(target, cast(loss_start - context_chars + 1 as int), cast(loss_end - loss_start as int))")
    ex = examples(segs).select(F.col("conv_id").alias("_conv"), F.struct("context_turns", unescape(reply).alias("m")).alias("x"))
    loss = ex.groupBy("_conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["m"]), "").alias("_loss"))
    out = per.join(loss, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("_loss", F.coalesce("_loss", F.lit("")))
    return out.select(*_digested("conv_id", F.col("n_turns"), turns, F.col("_loss"), F.col("formatted_chars")))


def digests(segs: DataFrame) -> DataFrame:
    """Per conversation, digests of what is read back from its examples and the rest behind them.

    SHA-256 of a conversation needs its text in one row, so its turns are aggregated here;
    that is the digest's need, not the formatting's. Conversations whose examples have over
    ``EXPANDED`` code points together are read back from the positional form."""
    whole = F.sum(F.length("segment").cast("long")) * F.count_if("is_target")
    long_ = stored(segs.groupBy("conv_id").agg(whole.alias("_n")).filter(F.col("_n") > EXPANDED).select(F.col("conv_id").alias("_long")), "long")
    if long_.isEmpty():
        return _from_expanded(segs)
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    return _from_expanded(segs.join(long_, same, "left_anti")).unionByName(_from_positions(segs.join(long_, same, "left_semi")))
