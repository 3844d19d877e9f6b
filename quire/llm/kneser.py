"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Tokens are words with A-Z lower-cased and one end per document. Training documents
give, in three shuffles of packed sorted runs:

1. vocabulary: word hashes (XXH64) and counts, in shards by leading bits; a word's id is
   its place among all sorted hashes;
2. bigrams: sorted (context id, word id) keys and counts. Shards are cut so that each
   has about ``SHARD_TOKENS`` training tokens: contexts in order of id, and a context
   with more tokens than that is spread over several shards by a hash of the word;
3. per id: in how many contexts a word occurs, and for a context its tokens and how many
   words follow it once, twice, and more often.

All runs are counted before they are shuffled, so a frequent word costs a row a task.
Reducers write the arrays to the shared folder; the driver sees a row of sums per shard.
Workers map the arrays and look up the distinct words and bigrams of a batch at a time.

The discounts of both orders are the usual ones from counts of counts; unigrams are
continuation counts, interpolated with a uniform share over the vocabulary and one
unknown word. A bigram model is the registered order: distinct trigrams are about 80 %
of the tokens of these texts, which the disk limit does not hold.

Defined cases. Null or empty text: the end alone. Null doc_id: as the empty text in the
hold-out rule. No training documents: the model is uniform over the unknown word and
every token's base is log10(0.1 / 0.1). Repeated rows count each. Other columns are
ignored. Counts have 64 bits. A vocabulary has less than 2^32 words, as a bigram's key has
32 bits for each; more raise an error. Two words of one hash would be one word: 2^-64 for each pair of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .common import ENTRY_BYTES, MEMO_BYTES, as_bytes, crc_mod, fresh_path, mix64

FOLDS = 10
SHARD_TOKENS, ID_BLOCK, BATCH_TOKENS = 2_000_000, 1 << 18, 1_000_000
WORDS_KEPT, FLUSH_WORDS = 400_000, 400_000
SHARD_DOCUMENTS, MAX_BITS = 4000, 20  # of a vocabulary shard; shards are 2 ** MAX_BITS at most, a row each on the driver
MAPS, COPIED_BYTES = 256, 128 << 20  # arrays that a worker holds open; bytes of those that it cannot map
_END = b"\n"  # no word holds white space


def _hashes(words) -> np.ndarray:
    from xxhash import xxh64_intdigest as digest

    return np.array([digest(w) for w in words], np.uint64)


def _pack(a: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their differences; high planes are zeros, which shuffles compress."""
    return np.ascontiguousarray(np.diff(a, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_counts(a: np.ndarray) -> bytes:
    """Counts as byte planes, 4 or 8 of them as the largest needs; their number comes first."""
    width = 4 if not len(a) or int(a.max()) < 1 << 32 else 8
    planes = a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def _unpack_counts(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{b[0]}").ravel()


def _small(a: np.ndarray) -> np.ndarray:
    """In 32 bits where all values fit."""
    return a.astype(np.uint32) if not a.size or int(a.max()) < 1 << 32 else a.astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return key[new], np.add.reduceat(n, new) if len(new) else n


class Counts:
    """The written arrays, as a worker sees them. Pickled as paths and offsets only."""

    def __init__(self, path: str, bits: int, lengths: list[int], tokens: list[int]):
        self.path, self.bits = path, bits
        self.offset = np.cumsum([0, *lengths])
        self.before = np.cumsum([0, *tokens])
        self.size, self.tokens = int(self.offset[-1]), int(self.before[-1])
        self.bos, self.unknown = self.size, self.size + 1
        self.documents = 0
        self.shards = 0
        self.bos_shard = self.tokens // SHARD_TOKENS + 1
        if self.unknown >= 1 << 32:
            raise OverflowError("a bigram's key has 32 bits for each word")

    def __reduce__(self):
        return _opened, (self.path, self.bits, np.diff(self.offset).tobytes(), np.diff(self.before).tobytes())

    def array(self, name: str) -> np.ndarray:
        kept = self.__dict__.setdefault("_arrays", arrays.Open(MAPS, COPIED_BYTES))
        return kept.get(f"{self.path}/{name}.npy")

    def ids(self, words) -> np.ndarray:
        """Ids of words; the unknown id for those that training has not."""
        h = _hashes(words)
        out = np.full(len(h), self.unknown, np.int64)
        shard = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(h)
        cuts = np.searchsorted(shard[order], np.arange((1 << self.bits) + 1))
        for s in np.unique(shard):
            if self.offset[s] == self.offset[s + 1]:
                continue
            at = order[cuts[s] : cuts[s + 1]]
            keys = self.array(f"vocabulary-{s}")
            i = np.searchsorted(keys, h[at])
            ok = keys[np.minimum(i, len(keys) - 1)] == h[at]
            out[at[ok]] = i[ok] + self.offset[s]
        return out

    def sequence(self, words: list[bytes]) -> np.ndarray:
        known = self.__dict__.setdefault("_known", {})
        if len(known) > WORDS_KEPT or self.__dict__.get("_known_bytes", 0) > MEMO_BYTES:
            known.clear()
            self._known_bytes = 0
        short = {w for w in words if w not in known}
        if short:
            short = list(short)
            known.update(zip(short, self.ids(short).tolist()))
            self._known_bytes = self.__dict__.get("_known_bytes", 0) + sum(map(len, short)) + len(short) * (ENTRY_BYTES + 65)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def of_ids(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of an array kept in vocabulary shards, for sorted ids of known words."""
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.offset)
        for s in np.flatnonzero(np.diff(cuts)):
            lo, hi = cuts[s], cuts[s + 1]
            out[lo:hi] = self.array(f"{name}-{s}")[ids[lo:hi] - self.offset[s]]
        return out

    def shard_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The bigram shard; contexts ascending."""
        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.empty(0, np.int64)
        at = context[new]
        known = at < self.size
        end = np.zeros(len(at), np.int64)
        own = np.zeros(len(at), np.int64)
        end[known] = self.of_ids("running", at[known])
        own[known] = self.of_ids("counts", at[known])
        s = np.searchsorted(self.offset, at[known], "right") - 1
        base = np.full(len(at), self.bos_shard, np.int64)
        base[known] = (self.before[s] + end[known] - own[known]) // SHARD_TOKENS
        spread = np.maximum(1, -(-own // SHARD_TOKENS))
        spread[~known] = max(1, -(-self.tokens // SHARD_TOKENS // 64))
        n = np.diff(np.r_[new, len(context)])
        base, spread = np.repeat(base, n), np.repeat(spread, n)
        return base + (mix64(word.astype(np.uint64)) % spread.astype(np.uint64)).astype(np.int64)


@lru_cache(maxsize=1)
def _opened(path: str, bits: int, lengths: bytes, tokens: bytes) -> Counts:
    return Counts(path, bits, *(np.frombuffer(x, np.int64).tolist() for x in (lengths, tokens)))


def _batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of about BATCH_TOKENS tokens with their documents' words."""
    for b in batches:
        start, words, n = 0, [], 0
        for i, t in enumerate(as_bytes(b.column(text))):
            w = t.lower().split()
            words.append(w)
            n += len(w) + 1
            if n >= BATCH_TOKENS:
                yield b.slice(start, i + 1 - start), words
                start, words, n = i + 1, [], 0
        if words:
            yield b.slice(start, len(words)), words


def _vocabulary(train: DataFrame, path: str, bits: int) -> Counts:
    def count(batches):
        total: Counter = Counter()

        def flush():
            words = list(total)
            h, n = _merged([_hashes(words)], [np.fromiter(total.values(), np.int64, len(words))])
            total.clear()
            cuts = np.searchsorted((h >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(cuts))
            parts = [slice(cuts[s], cuts[s + 1]) for s in full]
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array(full, pa.int32()), "k": [_pack(h[p]) for p in parts], "n": [_pack_counts(n[p]) for p in parts]}
            )

        for _, docs in _batches(batches, 0):
            for words in docs:
                total.update(words)
            total[_END] += len(docs)
            if len(total) > FLUSH_WORDS:
                yield flush()
        if total:
            yield flush()

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        s = key[0].as_py()
        h, n = _merged([_unpack(x) for x in t["k"].to_pylist()], [_unpack_counts(x) for x in t["n"].to_pylist()])
        arrays.save(f"{path}/vocabulary-{s}.npy", h)
        arrays.save(f"{path}/counts-{s}.npy", _small(n))
        arrays.save(f"{path}/running-{s}.npy", np.cumsum(n))
        return pa.table({"shard": pa.array([s], pa.int32()), "size": [len(h)], "tokens": [int(n.sum())]})

    runs = train.select("text").mapInArrow(count, "shard int, k binary, n binary")
    rows = runs.groupBy("shard").applyInArrow(merge, "shard int, size long, tokens long").collect()
    lengths, tokens = [0] * (1 << bits), [0] * (1 << bits)
    for r in rows:
        lengths[r["shard"]], tokens[r["shard"]] = r["size"], r["tokens"]
    return Counts(path, bits, lengths, tokens)


def _pairs(c: Counts, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: context and word ids of every token, and where each document begins."""
    flat = [w for words in docs for w in (*words, _END)]
    word = c.sequence(flat)
    n = np.array([len(words) + 1 for words in docs])
    start = np.cumsum(n) - n
    context = np.r_[np.int64(0), word[:-1]]
    context[start] = c.bos
    return context, word, start


def _bigrams(train: DataFrame, c: Counts) -> dict:
    path, block = c.path, ID_BLOCK

    def count(batches):
        for _, docs in _batches(batches, 0):
            context, word, _ = _pairs(c, docs)
            key, n = np.unique(context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), return_counts=True)
            shard = c.shard_of((key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64))
            order = np.argsort(shard, kind="stable")
            key, n, shard = key[order], n[order], shard[order]
            full, at = np.unique(shard, return_index=True)
            ends = [*at[1:], len(key)]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(full, pa.int32()),
                    "k": [_pack(key[a:b]) for a, b in zip(at, ends)],
                    "n": [_pack_counts(n[a:b]) for a, b in zip(at, ends)],
                }
            )

    def by_block(ids: np.ndarray, kind: int, *values: np.ndarray):
        cuts = np.flatnonzero(np.r_[True, ids[1:] // block != ids[:-1] // block]) if len(ids) else []
        for a, b in zip(cuts, [*cuts[1:], len(ids)]):
            yield kind, int(ids[a] // block), _pack(ids[a:b].astype(np.uint64)), *(_pack_counts(v[a:b]) for v in values), *[b""] * (4 - len(values))

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        s = key[0].as_py()
        k, n = _merged([_unpack(x) for x in t["k"].to_pylist()], [_unpack_counts(x) for x in t["n"].to_pylist()])
        arrays.save(f"{path}/bigram-{s}.npy", k)
        small = np.minimum(n, 255).astype(np.uint8)
        arrays.save(f"{path}/times-{s}.npy", small)
        big = np.flatnonzero(n >= 255)
        arrays.save(f"{path}/often-{s}.npy", np.stack([big, n[big]]).astype(np.int64))
        v, w = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        add = lambda x: np.add.reduceat(x.astype(np.int64), new)
        rows = [*by_block(v[new], 1, add(n), add(n == 1), add(n == 2), add(n > 2))]
        rows += by_block(*(x if i else x for i, x in enumerate([np.unique(w), 2])), np.unique(w, return_counts=True)[1])
        rows.append((0, 0, b"", _pack_counts(np.array([(n == i).sum() for i in (1, 2, 3, 4)] + [len(n), s + 1])), b"", b"", b""))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), _RUN)], schema=_RUN)

    def dense(key: tuple, t: pa.Table) -> pa.Table:
        kind, b = (x.as_py() for x in key)
        if kind == 0:  # counts of counts: a row per shard
            x = np.array([_unpack_counts(v).astype(np.int64) for v in t["a"].to_pylist()])
            return pa.table({"kind": pa.array([0], pa.int32()), "n": [x[:, :5].sum(0).tolist()]})
        out = np.zeros((4 if kind == 1 else 1, block), np.int64)
        for run, *values in zip(*(t[c].to_pylist() for c in "kabcd")):
            at = (_unpack(run) - np.uint64(b * block)).astype(np.int64)
            for i in range(len(out)):
                out[i, at] += _unpack_counts(values[i]).astype(np.int64)
        arrays.save(f"{path}/{'context' if kind == 1 else 'word'}-{b}.npy", _small(out))
        x = out[0]
        return pa.table({"kind": pa.array([kind], pa.int32()), "n": [[*((x == i).sum() for i in (1, 2, 3, 4)), int(x.sum())]]})

    runs = train.select("text").mapInArrow(count, "shard int, k binary, n binary")
    form = "kind int, block int, k binary, a binary, b binary, c binary, d binary"
    merged = runs.groupBy("shard").applyInArrow(merge, form)
    sums = merged.groupBy("kind", "block").applyInArrow(dense, "kind int, n array<bigint>")
    sums = sums.groupBy("kind").agg(*[F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(5)]).collect()
    return {r["kind"]: [int(r[f"n{i}"]) for i in range(5)] for r in sums}


_RUN = pa.schema([("kind", pa.int32()), ("block", pa.int32()), *((x, pa.binary()) for x in "kabcd")])


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off counts 0, 1, 2 and 3 or more."""
    if not n1 or not n2:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n3 else 1.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
    return np.array([0, *(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))])


class Model:
    """Probabilities from the written arrays."""

    def __init__(self, counts: Counts, sums: dict):
        self.counts, self.sums = counts, sums
        n1, n2, n3, n4, self.distinct = sums.get(0, [0] * 5)
        self.d2 = discounts(n1, n2, n3, n4)
        n1, n2, n3, n4, self.continuations = sums.get(2, [0] * 5)
        self.d1 = discounts(n1, n2, n3, n4)
        left = self.d1[1] * n1 + self.d1[2] * n2 + self.d1[3] * (counts.size - n1 - n2)
        self.uniform = (left / self.continuations if self.continuations else 1.0) / (counts.size + 1)

    def _dense(self, name: str, ids: np.ndarray, rows: int) -> np.ndarray:
        """Columns of the id arrays for sorted ids; zeros beyond what was written."""
        c, out = self.counts, np.zeros((rows, len(ids)), np.int64)
        blocks = ids // ID_BLOCK
        for b in np.unique(blocks):
            lo, hi = np.searchsorted(blocks, [b, b + 1])
            at = ids[lo:hi] - b * ID_BLOCK
            try:
                out[:, lo:hi] = c.array(f"{name}-{b}")[:, at]
            except FileNotFoundError:
                if b * ID_BLOCK < c.size:
                    raise
        return out

    def unigrams(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw count and lower-order probability for sorted ids."""
        c = self.counts
        known = ids < c.size
        raw = np.zeros(len(ids), np.int64)
        raw[known] = c.of_ids("counts", ids[known])
        p = np.full(len(ids), self.uniform)
        if known.any():
            n = self._dense("word", ids[known], 1)[0]
            p[known] += np.maximum(n - self.d1[np.minimum(n, 3)], 0) / max(self.continuations, 1)
        return raw, p

    def bigram_counts(self, key: np.ndarray) -> np.ndarray:
        """Training counts of sorted distinct (context << 32 | word)."""
        c = self.counts
        v, w = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out = np.zeros(len(key), np.int64)
        ok = np.flatnonzero((v <= c.bos) & (w < c.size))
        shard = c.shard_of(v[ok], w[ok])
        order = np.argsort(shard, kind="stable")
        ok, shard = ok[order], shard[order]
        full, at = np.unique(shard, return_index=True)
        for s, a, b in zip(full, at, [*at[1:], len(ok)]):
            try:
                keys = c.array(f"bigram-{s}")
            except FileNotFoundError:  # no training bigram fell into it
                continue
            q = key[ok[a:b]]
            i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
            hit = keys[i] == q
            n = np.where(hit, c.array(f"times-{s}")[i], 0).astype(np.int64)
            if (n == 255).any():
                often = c.array(f"often-{s}")
                j = np.flatnonzero(n == 255)
                n[j] = often[1][np.searchsorted(often[0], i[j])]
            out[ok[a:b]] = n
        return out

    def score(self, docs: list[list[bytes]]) -> dict[str, np.ndarray]:
        c = self.counts
        context, word, start = _pairs(c, docs)
        ids, at = np.unique(word, return_inverse=True)
        raw, low = self.unigrams(ids)
        base = np.log10((raw + 0.1) / (c.tokens + 0.1 * (c.size + 1)))
        key, which = np.unique(context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), return_inverse=True)
        n = self.bigram_counts(key)
        ctx, where = np.unique((key >> np.uint64(32)).astype(np.int64), return_inverse=True)
        total, n1, n2, n3 = self._dense("context", ctx, 4)
        gamma = np.where(total > 0, (self.d2[1] * n1 + self.d2[2] * n2 + self.d2[3] * n3) / np.maximum(total, 1), 1.0)
        lower = low[np.searchsorted(ids, (key & np.uint64(0xFFFFFFFF)).astype(np.int64))]
        p = np.maximum(n - self.d2[np.minimum(n, 3)], 0) / np.maximum(total[where], 1) + gamma[where] * lower
        sums = lambda x: np.add.reduceat(x, start)
        return {
            "n_tokens": np.diff(np.r_[start, len(word)]),
            "n_known": sums((raw[at] > 0).astype(np.int64)),
            "base_score": sums(base[at]),
            "score": sums(np.log10(p)[which]),
        }


def fit(documents: DataFrame, folds: int = FOLDS) -> Model:
    """Counts the documents that are not held out and writes the model to the shared folder."""
    train = documents.filter(crc_mod(F.col("doc_id"), folds) != 0)
    n = train.count()
    bits = min(MAX_BITS, max(4, int(np.ceil(np.log2(max(n, 1) / SHARD_DOCUMENTS + 1)))))
    path = fresh_path(documents.sparkSession, "kneser")
    counts = _vocabulary(train, path, bits)
    return Model(counts, _bigrams(train, counts) if counts.size else {})


def scored(documents: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row."""
    counts, sums = model.counts, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(counts, sums)
        for b, docs in _batches(batches, 1):
            got = m.score(docs)
            columns = {"doc_id": b.column(0), "held_out": b.column(2)} | {k: pa.array(v) for k, v in got.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = documents.schema["doc_id"].dataType.simpleString()
    form = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    out = documents.select("doc_id", "text", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out")).mapInArrow(run, form)
    out = out.withColumn("train_tokens", F.lit(counts.tokens).cast("long"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
