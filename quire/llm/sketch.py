"""Document fingerprints by threshold-scaled sketches.

A sketch keeps every 5-word shingle hash below a fixed fraction of the hash range, so
its size follows the document's, two sketches of very unequal documents are comparable,
and the union of sketches is the sketch of the union. ``FRACTION`` is set for documents of
some hundred words, which keep some dozens of hashes. Only a text that would keep none
keeps its ``FLOOR`` = 1 smallest hash; the union rule still holds if the smallest is taken
again. Two sketches are compared below the smaller of their thresholds, under which both
are complete.

Shingles are of words with A-Z lower-cased; a text of fewer than five words is one
shingle. A fingerprint is written as the hashes in ascending order, hex, 16 digits each.

Edited texts need each document's next one by doc_id. Rows are dealt into ranges of
doc_id at quantiles taken over all ids, sorted within a range, and the first row of a
range is also sent to the range before it; so each text is shuffled once, and a range
is read as a stream.

Defined cases. Null text: empty; its sketch is empty and written "". Two empty
sketches are alike (1), an empty and a full one are not (0). Rows of equal doc_id: in
order of a hash of the text; null doc_id first. A single document is its own next. Empty table: empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, mix64

SHINGLE, FRACTION, FLOOR = 5, 1 / 4, 1
KEPT_BYTES = 48
RANGE_ROWS, MAX_RANGES = 500, 20_000
_ALL = 2**64 - 1


def _hasher():
    from xxhash import xxh64_intdigest as digest

    known = Memo(digest)
    return lambda words: np.fromiter((known[w] if len(w) <= KEPT_BYTES else digest(w) for w in words), np.uint64, len(words))


def sketch(text: bytes, hash_words, fraction: float = FRACTION, floor: int = FLOOR) -> np.ndarray:
    """The retained hashes of a text in UTF-8, ascending."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    k = min(SHINGLE, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
        out ^= out >> np.uint64(29)
    out = np.unique(mix64(out))
    below = int(np.searchsorted(out, np.uint64(min(int(fraction * 2**64), _ALL))))
    return out[: max(below, floor)]


def limit(s: np.ndarray, fraction: float = FRACTION, floor: int = FLOOR) -> int:
    """The largest hash up to which a sketch is complete."""
    if len(s) < floor:
        return _ALL
    return max(int(s[floor - 1]), int(fraction * 2**64) - 1)


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Estimates of two sketches' Jaccard likeness, and of containment in the smaller."""
    top = np.uint64(min(limit(a), limit(b)))
    a, b = a[: np.searchsorted(a, top, "right")], b[: np.searchsorted(b, top, "right")]
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / min(len(a), len(b))


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION, floor: int = FLOOR) -> np.ndarray:
    """The sketch of two documents' shingles together."""
    out = np.union1d(a, b)
    return out[: max(int(np.searchsorted(out, np.uint64(int(fraction * 2**64)))), floor)]


def written(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = _hasher()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = pa.array([len(t) for t in texts], pa.int64())
            f = pa.array([written(sketch(t.encode(), hash_words)) for t in texts])
            yield pa.RecordBatch.from_arrays([b.column(0), n, f], ["doc_id", "n_chars", "fingerprint"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars bigint, fingerprint string")


def _with_next(documents: DataFrame) -> DataFrame:
    """range, ahead, doc_id, text, sorted within partitions so that a row is followed by the next
    one by doc_id; ``ahead`` marks rows that are there for the row before them only.

    The driver holds a cut and a lowest id for each range: ``MAX_RANGES`` pairs at most.
    """
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    pieces = min(MAX_RANGES, max(1, -(-ids.count() // RANGE_ROWS)))
    cuts = ids.approxQuantile("doc_id", [i / pieces for i in range(1, pieces)], 0.25 / pieces) if pieces > 1 else []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def range_of(x: pd.Series) -> pd.Series:
        return pd.Series([0 if v is None else int(np.searchsorted(cuts, v, "right")) for v in x.astype(object).where(x.notna(), None)])

    low = ids.select("doc_id", range_of("doc_id").alias("r")).groupBy("r")
    low = low.agg(F.min("doc_id").alias("low"), F.bool_or(F.col("doc_id").isNull()).alias("nulls")).collect()
    found = {x["r"]: None if x["nulls"] else x["low"] for x in low}
    order = sorted(found)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range's is the last

    @F.pandas_udf("array<int>")
    def dealt(x: pd.Series) -> pd.Series:
        out = []
        for v in x.astype(object).where(x.notna(), None):
            r = 0 if v is None else int(np.searchsorted(cuts, v, "right"))
            out.append([2 * r, 2 * before[r] + 1] if v == found[r] else [2 * r])
        return pd.Series(out)

    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_k", F.explode(dealt("doc_id")))
        .select(F.floor(F.col("_k") / 2).cast("int").alias("range"), (F.col("_k") % 2).alias("ahead"), "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter gives way to the start of ``following``."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def fingerprinted(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    (Jaccard), contained_edited, contained_next (containment in the smaller) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = _hasher()
        last = None  # range, ahead, doc_id, text, sketch
        out: list[tuple] = []

        def rows_of(b: pa.RecordBatch):
            for at in range(0, b.num_rows, 64):
                yield from zip(*(c.to_pylist() for c in b.slice(at, 64).columns))

        def done():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _FORM)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_FORM)

        for b in batches:
            for r, ahead, doc_id, text in rows_of(b):
                now = (r, ahead, doc_id, text, sketch(text.encode(), hash_words))
                if last is not None and not last[1] and last[0] == r:
                    _, _, i, t, s = last
                    e = edited(t, text)
                    f = sketch(e.encode(), hash_words)
                    (ne, ce), (nn, cn) = compare(s, f), compare(s, now[4])
                    sha = hashlib.sha256(e.encode()).hexdigest()
                    out.append((i, len(t), sha, written(s), written(f), ne, nn, ce, cn))
                    if len(out) == 256:
                        yield done()
                last = now
        if out:
            yield done()

    form = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    form += "near_edited double, near_next double, contained_edited double, contained_next double"
    return _with_next(documents).mapInArrow(run, form)


_FORM = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(c, pa.float64()) for c in ("near_edited", "near_next", "contained_edited", "contained_next")]
)
