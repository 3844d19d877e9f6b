"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash of its id. A source's mix takes each of its documents
``floor(target / source_size)`` times, and once more if the hash is at or below
the source's threshold. The threshold comes from histograms: words are summed by
source and leading hash bits, the bucket in which the running sum passes the
budget is found, and only that bucket is opened by the next bits, level by level,
until single hash values are left. Rows are then filtered by comparison; they are
never sorted.

The document at the boundary does not fit and stays out. What is left of the budget is
given to further passes of the same kind behind the boundary, each among documents no
larger than its rest, so a source with ids of its own misses its target by a small part of one
document. A repeated id that doesn't fit as a whole stays out, and passes go on behind it.

Defined cases. Null text: size 0. Null source: a source of its own, last in
order. Null doc_id: hashed as the empty text. Rows of one doc_id have one hash and
share their fate. A source of size 0 has target 0. Empty table: empty result.
Other columns pass through ``mixed`` and are ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import WORD, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
HASH_BITS, LEVEL_BITS, PASSES = 60, 12, 3
ALL = (1 << HASH_BITS) - 1


def _hash(doc_id: Column) -> Column:
    hex_ = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(hex_, 1, HASH_BITS // 4), 16, 10).cast("long")


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, h for every row; the only pass over texts."""
    return documents.select(
        "doc_id", F.col("source").cast("string").alias("source"), _size(F.col("text")).alias("size"), _hash(F.col("doc_id")).alias("h")
    )


def targets(sized: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target, copies, budget: one row per source.

    Weights repeat along the sources in code point order, null last. All targets
    together are the whole corpus. A target stops at ``max_repeat`` times its
    source's size, and the rest is shared again by weight: with sources ordered by
    cap / weight, the level at which sharing comes to rest follows from one running
    sum. Windows without a key are over one row per source only.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.lit(weights[-1])
    for k, v in reversed(list(enumerate(weights[:-1]))):
        w = F.when((F.row_number().over(order) - 1) % len(weights) == k, F.lit(v)).otherwise(w)
    per = per.withColumn("w", w.cast("double")).withColumn("cap", (F.lit(max_repeat) * F.col("source_size")).cast("double"))
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    prior = by.rowsBetween(W.unboundedPreceding, -1)
    rest = by.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(prior), F.lit(0.0))) / F.sum("w").over(rest),
    )
    # the first source whose share is within its cap sets the level; levels after it are lower, as they count it at its cap
    per = per.withColumn("level", F.max(F.when(F.col("w") * F.col("level") <= F.col("cap"), F.col("level"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("w") * F.col("level"), F.col("cap")))
    per = per.withColumn("target", target)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    per = per.withColumn("copies", copies.cast("long"))
    return per.select(
        "source",
        "source_size",
        "target",
        "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
    )


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """source, copies, target, source_size and the nested thresholds: t1..tn (largest hash taken; -1: none),
    f1..fn (the boundary, behind which the next pass begins) and r1..rn (the budget each had, in words).

    Pass 1 takes hashes in order up to the last that fits the budget. What is left of the
    budget is smaller than the next document; pass 2 goes on behind it, among documents no
    larger than that rest, and so forth.
    """
    state = goals.withColumn("r1", F.floor("budget").cast("long"))
    for k in range(1, PASSES + 1):
        state = _one_pass(sized, state, k)
    return state


def _candidates(k: int):
    """Rows open to pass k: behind the boundary of the pass before, and no larger than the rest."""
    return (F.col("h") > (F.col(f"f{k - 1}") if k > 1 else F.lit(-1))) & (F.col("size") <= F.col(f"r{k}"))


def _one_pass(sized: DataFrame, state: DataFrame, k: int) -> DataFrame:
    low = F.lit(-1).cast("long") if k == 1 else F.col(f"t{k - 1}")
    state = state.withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long"))
    behind = low if k == 1 else F.col(f"f{k - 1}")
    spent = F.col(f"r{k}") <= 0
    state = stored(state.withColumn("threshold", F.when(spent, low)).withColumn("behind", F.when(spent, behind)), "goals")
    columns = state.columns
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        open_ = state.filter("threshold IS NULL").withColumnRenamed("source", "_s")
        same = F.col("source").eqNullSafe(F.col("_s"))
        wanted = same & _candidates(k)
        if shift < HASH_BITS - LEVEL_BITS:
            wanted &= F.shiftright(F.col("h"), shift + LEVEL_BITS) == F.col("prefix")
        keys = open_.select("_s", "prefix", *[f"f{i}" for i in range(1, k)], f"r{k}")
        hist = (
            sized.join(keys, wanted)
            .groupBy("source", F.shiftright(F.col("h"), shift).alias("bucket"))
            .agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        )
        run = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        passed = (
            hist.withColumn("run", F.coalesce(F.sum("n").over(run), F.lit(0)))
            .join(open_.select("_s", "before", f"r{k}"), same)
            .withColumn("b0", F.col("before") + F.col("run"))
            .filter((F.col("b0") <= F.col(f"r{k}")) & (F.col("b0") + F.col("n") > F.col(f"r{k}")))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "b0", "lo", "hi")).alias("x"))
            .select(F.col("source").alias("_s"), "x")
        )
        state = stored(
            state.join(passed, same, "left")
            .withColumn(
                "behind",
                F.when(F.col("behind").isNotNull(), F.col("behind"))
                .when(F.col("x").isNull(), F.lit(ALL))
                .when(F.col("x.lo") == F.col("x.hi"), F.col("x.hi")),
            )
            .withColumn(
                "threshold",
                F.when(F.col("threshold").isNotNull(), F.col("threshold"))
                .when(F.col("x").isNull(), F.lit(ALL))  # the budget holds all that is left
                .when(F.col("x.lo") == F.col("x.hi"), F.col("x.lo") - 1),  # a single hash value: it doesn't fit
            )
            .withColumn("prefix", F.coalesce(F.col("x.bucket"), F.col("prefix")))
            .withColumn("before", F.coalesce(F.col("x.b0"), F.col("before")))
            .select(*columns),
            "goals",
        )
        if state.filter("threshold IS NULL").isEmpty():
            break
    # what lies before the boundary is what the pass takes; where the budget held all, nothing is left to take
    rest = F.when((F.col(f"r{k}") <= 0) | (F.col("threshold") == ALL), F.lit(0)).otherwise(F.col(f"r{k}") - F.col("before"))
    return state.withColumn(f"r{k + 1}", rest.cast("long")).withColumnRenamed("threshold", f"t{k}").withColumnRenamed("behind", f"f{k}").drop("prefix", "before")


def _times():
    """How often a row is taken, from its hash, its size and its source's thresholds."""
    once = F.lit(False)
    for k in range(1, PASSES + 1):
        once |= _candidates(k) & (F.col("h") <= F.col(f"t{k}"))
    return F.col("copies") + once.cast("long")


def _joined(sized: DataFrame) -> DataFrame:
    goals = stored(thresholds(sized, targets(sized)).withColumnRenamed("source", "_s"), "goals")
    return sized.join(goals, F.col("source").eqNullSafe(F.col("_s"))).withColumn("times", _times())


def plan(documents: DataFrame) -> DataFrame:
    """doc_id, size, source, h, source_size, target, times, taken for every row of ``documents``."""
    sized = stored(sizes(documents), "sizes")
    taken = (F.col("times") * F.col("size")).alias("taken")
    return _joined(sized).select("doc_id", "size", "source", "h", "source_size", "target", "times", taken)


def mixed(documents: DataFrame) -> DataFrame:
    """The mix itself: rows of ``documents``, each as often as the mix takes it. Texts are not shuffled
    where the table of sources is small enough for Spark to broadcast."""
    sized = stored(sizes(documents), "sizes")
    own = stored(thresholds(sized, targets(sized)).withColumnRenamed("source", "_s"), "goals")
    extra = {"h": _hash(F.col("doc_id")), "size": _size(F.col("text")), "_source": F.col("source").cast("string")}
    out = documents.select(F.struct("*").alias("_row"), *[c.alias(n) for n, c in extra.items()])
    out = out.join(own, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("times", _times()).filter("times > 0")
    return out.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("_row.*")
