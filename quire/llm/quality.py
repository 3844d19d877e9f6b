"""Quality classifier: supervised embeddings of hashed words and character n-grams.

A document is the mean of learned vectors, one for each occurrence of a word and of
each of its character n-grams (of ``<word>``, in bytes), hashed into a fixed number of
buckets, and one for each window of two and of three words, by the window's pattern of equal
words (``aa ab``, ``aaa aab aba abb abc``): word n-grams up to renaming, which generalise to
words never seen. A linear layer and a softmax give the class probabilities. Vectors and
layer are trained together by stochastic gradient descent in numpy.

Training reads a bounded sample: the ``MAX_TRAIN`` labelled documents with the lowest
md5 of their id among those not held out. Executors turn their whole texts into bucket
counts; the driver gets these only. As the layer is linear in the mean, every bucket's
vector is multiplied by the layer once, and scoring sums one number per feature; sums
per word are kept in a bounded table. The model that goes out to the workers is
``BUCKETS`` floats, whatever the corpus.

Defined cases. Null or wordless text: the score of the bias alone. Null labels: not
used. Labels repeated for a document: the highest. Without any label: score 0.5.
Repeated rows: scored each; in training, one document once. Null doc_id: as the empty
text in the hold-out rule. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import and_, eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest as _digest

from .common import ENTRY_BYTES, MEMO_BYTES, as_bytes, crc_mod, leave_small

FOLDS, THRESHOLD = 5, 0.3
BUCKETS, DIM, MIN_N, MAX_N = 1 << 17, 8, 3, 4
MAX_TRAIN, EPOCHS, RATE = 2500, 6, 2.0
KEPT_BYTES, SLICE = 48, 512
PATTERNS = ("aa", "ab", "aaa", "aab", "aba", "abb", "abc")


def word_features(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    marked = b"<" + word + b">"
    out = [_digest(word, 1) % BUCKETS]
    for n in range(MIN_N, MAX_N + 1):
        out += [_digest(marked[i : i + n], 2) % BUCKETS for i in range(len(marked) - n + 1)]
    return out


def pattern_features() -> list[int]:
    """The bucket of each pattern."""
    return [_digest(p, 3) % BUCKETS for p in PATTERNS]


def pattern_counts(words: list[bytes]) -> list[int]:
    """How many windows of two and three words have each pattern."""
    n2, n3 = max(len(words) - 1, 0), max(len(words) - 2, 0)
    near = list(map(eq, words, words[1:]))
    both = sum(map(and_, near, near[1:]))
    aa = sum(near)
    aab, abb = (aa - both - near[-1], aa - both - near[0]) if n3 else (0, 0)
    aba = sum(map(eq, words, words[2:])) - both  # first and third are equal: aaa or aba
    return [aa, n2 - aa, both, aab, aba, abb, n3 - both - aab - aba - abb]


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text, ascending, and how often each occurs."""
    words = text.split()
    total: Counter = Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            total[f] += n
    for f, n in zip(pattern_features(), pattern_counts(words)):
        total[f] += n
    order = sorted(f for f, n in total.items() if n)
    return np.array(order, np.int32), np.array([total[f] for f in order], np.int32)


def training_rows(documents: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """label, ids, n: the bounded sample as bucket counts, in a fixed order."""
    pick = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .filter(crc_mod(F.col("doc_id"), FOLDS) != 0)
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("quality").alias("_label"))
        .join(documents.select(F.col("doc_id").alias("_id")), "_id", "left_semi")
        .withColumn("_order", F.md5(F.col("_id").cast("string").cast("binary")))
        .orderBy("_order", "_id")
        .limit(limit)
    )
    # at most ``limit`` rows of three short columns
    found = documents.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(pick), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(as_bytes(b.column(3))):
                ids, n = counts(t)
                row = [b.column(0).slice(i, 1), b.column(1).slice(i, 1), b.column(2).slice(i, 1)]
                row += [pa.array([ids.tobytes()]), pa.array([n.tobytes()])]
                yield pa.RecordBatch.from_arrays(row, ["_order", "_id", "_label", "ids", "n"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    label = labels.schema["quality"].dataType.simpleString()
    return found.select("_order", "_id", "_label", "text").mapInArrow(
        run, f"_order string, _id {kind}, _label {label}, ids binary, n binary"
    )


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """The weight of each bucket for label 1 over label 0, and the bias; by SGD over documents in a seeded order."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    if not rows:
        return np.zeros(BUCKETS, np.float32), 0.0
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, ids, n = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            share = (n / max(n.sum(), 1)).astype(np.float32)
            hidden = share @ vectors[ids]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= 0.1 * rate * np.outer(hidden, p)
            bias -= 0.02 * rate * p
            vectors[ids] -= rate * share[:, None] * back * 4
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    got = sorted(training_rows(documents, labels, limit).collect(), key=lambda r: (r["_order"], r["_id"]))
    seen, rows = set(), []
    for r in got:
        if r["_id"] not in seen:
            seen.add(r["_id"])
            rows.append((int(r["_label"] > 0), np.frombuffer(r["ids"], np.int32), np.frombuffer(r["n"], np.int32)))
    return train(rows)


class _Scorer:
    """Scores of texts. Sums per word are kept in two tables of bounded bytes: a full one gives way
    to an empty one and serves it until that is full too, so frequent words stay."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float64), bias
        self.patterns = self.weights[pattern_features()].tolist()
        self.known: dict[bytes, complex] = {}
        self.older: dict[bytes, complex] = {}
        self.used = 0

    def _new(self, words: list[bytes]) -> list[complex]:
        """Of words: the sum of their features' weights as the real part, the number of features as the imaginary one."""
        if not words:
            return []
        found = [word_features(w) for w in words]
        n = np.fromiter(map(len, found), np.int64, len(found))
        sums = np.add.reduceat(self.weights[np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))], np.cumsum(n) - n)
        return (sums + 1j * n).tolist()

    def all(self, texts: list[bytes]) -> np.ndarray:
        words = [t.split() for t in texts]
        if self.used > MEMO_BYTES // 2:
            self.older, self.known, self.used = self.known, {}, 0
        known, older = self.known, self.older
        lack = set().union(*words).difference(known)
        found = {w: older[w] for w in lack if w in older}
        new = list(lack.difference(found))
        found.update(zip(new, self._new(new)))
        known.update(found)
        z = np.full(len(texts), self.bias)
        for i, w in enumerate(words):
            if w:
                total = sum(map(known.__getitem__, w))
                total += sum([complex(n * x, n) for n, x in zip(pattern_counts(w), self.patterns)])
                z[i] += total.real / total.imag
        for w in found:
            if len(w) > KEPT_BYTES:
                del known[w]
            else:
                self.used += len(w) + 65 + ENTRY_BYTES
        return 1 / (1 + np.exp(-z))


def scored(documents: DataFrame, model: tuple[np.ndarray, float], keep: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; with ``keep``, the rows of
    ``documents`` that are not rejected, in their own columns."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model)  # BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer(*sent.value)
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            s = np.concatenate([np.empty(0)] + [score.all(as_bytes(texts.slice(i, SLICE))) for i in range(0, len(texts), SLICE)])
            if keep:
                yield b.filter(pa.array(s >= THRESHOLD))
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s)], ["doc_id", "held_out", "score"])

    if keep:
        return documents.mapInArrow(leave_small(run), documents.schema)
    out = documents.select("doc_id", "text", (crc_mod(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    out = out.mapInArrow(leave_small(run), f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def classified(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(documents, fit(documents, labels))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the classifier does not reject."""
    return scored(documents, fit(documents, labels), keep=True)
