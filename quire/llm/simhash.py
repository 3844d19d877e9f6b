"""SimHash near-duplicate groups by multi-index hashing.

Fingerprint: 64 bits over the 4-word shingles (repeats included) of the text with
A-Z lower-cased; a bit is 1 if set in over half of the shingles' XXH64 (seed 42).
Equal fingerprints are merged first, so copies cost one row each from there on.

Links (4 or fewer differing bits) are found over three segments of 22, 21 and 21
bits. Of two linked fingerprints at least one segment differs in one bit at most, so
tables keyed by segment value are asked for the ball of radius 1 around each value.
A ball is entered from one side only: a fingerprint looks up the values with one
more bit set, and meets those that hold them. What meets in a table is verified on
the whole distance.

Skew: rows that meet under one key are compared in place and leave a spanning forest
of their links, never all pairs. A key with more than ``CELL`` rows is split into
blocks, and each pair of blocks is a cell of its own, so a task holds two blocks.

Defined cases. Null or wordless text: fingerprint zero, linked like any other. Fewer
than 4 words: one shingle. Null doc_id: left out of minimums; a group of nulls alone
has a null component. Repeated rows are rows. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, leave_small, stored
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CELL = 8192


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of a text given in UTF-8."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return digest(joined, SEED)
    n = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(n + 1) - 1
    starts = (ends - n)[: len(words) - k + 1].tolist()
    set_ = np.zeros(64, np.int64)
    m = len(starts)
    ends = ends[k - 1 :].tolist()
    for at in range(0, m, 1 << 16):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])], np.uint64)
        set_ += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > m, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in as_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(leave_small(run), f"doc_id {kind}, fp bigint")


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys, owners = [], []
        for s, (low, width) in enumerate(SEGMENTS):
            value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
            tag = np.uint64(s << 24)
            keys.append(value | tag)
            owners.append(fp)
            for bit in range(width):
                one = np.uint64(1 << bit)
                unset = (value & one) == 0
                keys.append(value[unset] | one | tag)
                owners.append(fp[unset])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).astype(np.int32)), pa.array(np.concatenate(owners).view(np.int64))], ["key", "fp"]
        )


def _forest(fp: np.ndarray, out: list) -> None:
    """Adds a spanning forest of the links among ``fp`` to ``out``, breadth first."""
    left = np.unique(fp)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= RADIUS
            if near.any():
                hit = left[near]
                out.append((np.full(len(hit), x), hit))
                queue.extend(hit)
                left = left[~near]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key, ci, cj: the links found within each group."""

    def found(key: np.ndarray, fp: np.ndarray):
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[new, len(key)])
        out: list = []
        size = np.repeat(n, n)
        for d in range(1, 16):
            ok = (key[d:] == key[:-d]) & (size[d:] <= 16)
            at = np.flatnonzero(ok)
            if not len(at):
                break
            a, b = fp[at], fp[at + d]
            x = np.bitwise_count(a ^ b)
            near = (x <= RADIUS) & (x > 0)
            out.append((a[near], b[near]))
        for i in np.flatnonzero(n > 16):
            _forest(fp[new[i] : new[i] + n[i]], out)
        if out:
            a, b = (np.concatenate(x) for x in zip(*out))
            a, b = a.view(np.int64), b.view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        return None

    key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
    for b in batches:
        k = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) << 32
        k |= b.column(1).to_numpy(zero_copy_only=False).astype(np.int64) << 16
        k |= b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        key = np.concatenate([key, k])
        fp = np.concatenate([fp, b.column(3).to_numpy(zero_copy_only=False).view(np.uint64)])
        if len(key) > (1 << 18):
            cut = int(np.searchsorted(key, key[-1]))  # the last group may go on
            if cut and (done := found(key[:cut], fp[:cut])):
                yield done
            key, fp = key[cut:], fp[cut:]
    if len(key) and (done := found(key, fp)):
        yield done


def links(fps: DataFrame) -> DataFrame:
    """a, b: links that connect the distinct fingerprints in column ``fp`` as all their links do."""
    probes = fps.mapInArrow(leave_small(_probes), "key int, fp bigint")
    heavy = probes.groupBy("key").count().filter(F.col("count") > CELL)
    heavy = heavy.select("key", F.ceil(F.col("count") / CELL).cast("int").alias("g"))
    p = probes.join(heavy, "key", "left").withColumn("g", F.coalesce("g", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("g") - 1),
        lambda j: F.struct(F.least(j, F.col("_i")).alias("ci"), F.greatest(j, F.col("_i")).alias("cj")),
    )
    one = F.array(F.struct(F.lit(0).alias("ci"), F.lit(0).alias("cj")))
    p = p.withColumn("_i", own).withColumn("cell", F.explode(F.when(F.col("g") == 1, one).otherwise(cells)))
    p = p.select("key", F.col("cell.ci").alias("ci"), F.col("cell.cj").alias("cj"), "fp")
    p = p.repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj")
    return p.mapInArrow(leave_small(_links), "a bigint, b bigint")


def _labelled(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stored(fingerprints(documents), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp")))
    labelled = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, labelled.select("fp", "root").join(lowest, "root").select("fp", "root", "component_id")


def grouped(documents: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) for every row of ``documents``."""
    rows, named = _labelled(documents)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each group, that of the smallest doc_id.

    Texts are shuffled once, by doc_id, in a merge join at any size. Where that doc_id is null
    or rows repeat it, one of its rows in each group stays; only such rows, where there are any,
    are fingerprinted again to tell their groups apart.
    """

    @F.pandas_udf("bigint")
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint((t or "").encode()) for t in texts], np.uint64).view(np.int64))

    fp_of = fp_of.asNondeterministic()  # else a join on it computes it for all rows
    rows, named = _labelled(documents)
    own = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = rows.join(named, "fp").groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"), own.alias("_own")).filter("_own")
    stay = stay.select("_id", F.when(F.col("_id").isNull(), 2).otherwise(F.col("_n")).alias("_n"))
    stay = stored(stay, "stay")
    whole = documents.select(F.struct("*").alias("_row"))  # whatever names the columns have
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id"))
    once = whole.join(stay.filter("_n = 1").hint("merge"), same).select("_row.*")
    repeated = stay.filter("_n > 1")
    if repeated.isEmpty():
        return once
    again = whole.join(repeated, same).select("_row", "_id", fp_of(F.col("_row.text")).alias("_fp"))
    named = named.select(F.col("fp").alias("_f"), F.col("root").alias("_r"), F.col("component_id").alias("_c"))
    again = again.join(named, (F.col("_fp") == F.col("_f")) & F.col("_id").eqNullSafe(F.col("_c")))
    return once.unionByName(again.dropDuplicates(["_id", "_r"]).select("_row.*"))
