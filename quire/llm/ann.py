"""Approximate nearest neighbours by adaptive dimension scans over inverted lists.

Index. Vectors are dealt to inverted lists by spherical k-means fitted on a bounded
sample (rows of lowest hash: ``PER_LIST`` a list, ``SAMPLE`` at least); every row is
indexed. There are about as many lists as the root of the rows, up to ``MAX_LISTS``. Rows
with the same vector are one entry that carries the ids which can be among anyone's nearest:
the ``k`` + 1 smallest (one may be the query's own), which loses nothing as ties go to
smaller ids. Neighbouring lists share a cell; a large cell is cut into chunks by hash, and
its queries into blocks, so that a task holds some ``CHUNK`` entries and ``ASKED`` queries.

Probes. A query probes the lists with the centres of largest inner product. How many is
measured: for ``TRIED`` rows of the sample, the fewest lists that hold the share ``COVER`` of
their exact nearest rows in the sample. Vectors without cluster structure need most lists
(random unit vectors of 64 dimensions: some 0.75 of them), so the scan's work then grows with
queries times rows; clustered ones need few.

Scan. All vectors are turned by one random rotation and read in blocks of columns. For
each query and probed list, the hypothesis that a candidate's inner product reaches the k-th
best so far is tested on the share f of the dimensions read so far: under it, their part
of the product is about f times that bound, with deviation |q| |x| sqrt(f (1 - f) / dims)
over random rotations. A candidate is abandoned when its part is ``EPSILON`` deviations
short of that, or when even parallel rests would not lift it; the test's error is part of
the measured recall. Blocks are read for whole lists while many candidates are alive,
and for the survivors alone after that. What is left is scored on the original vectors
in doubles. All this is done on what a row differs by from its list's mean, whose own product
is known, as rows of a cluster share their error else. The first bound comes from ``SEEDS`` rows of the query's nearest list; a first
round scans every query's own cell, and its k-th best is the bound for the cells of the
second, which give back only what is better.

Defined cases. Null, zero and non-finite vectors, and vectors of another length than
the most frequent one, take no part, as queries or candidates. Null ids take no part as
queries; as candidates neither. Repeated rows of one id and vector are one candidate; one id
with several vectors is a query and a candidate with each, and no neighbour of itself. Ties: smaller id first. Fewer candidates than k: all. Empty table:
empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import stored

SAMPLE, PER_LIST, MAX_LISTS = 20_000, 16, 16_384
CHUNK, LEAST_CHUNK, ASKED, SPREAD = 32_768, 1024, 20_000, 12
COVER, TRIED, EPSILON, BLOCK = 0.97, 256, 2.3, 16
SEEDS, MANY, HELD = 64, 0.25, 2_000_000


def usable(vectors: DataFrame) -> DataFrame:
    """id, x: the rows that take part, as arrays of doubles."""
    x = F.col("embedding").cast("array<double>")
    v = vectors.select(F.col("vec_id").cast("long").alias("id"), x.alias("x")).filter("id IS NOT NULL AND x IS NOT NULL")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = v.filter(fine & F.exists("x", lambda e: e != 0))
    length = v.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return v.filter(F.size("x") == (length["n"] if length else 0))


def entries(v: DataFrame, k: int) -> DataFrame:
    """id, x, ids: one row per distinct vector; id is its smallest, ids the k + 1 smallest."""
    # rank filters are applied before the shuffle too, so a frequent vector sends k + 1 rows a task
    w = W.partitionBy("x").orderBy("id")
    few = v.distinct().withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k + 1)
    return few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "x", "ids")


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 6, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centres = unit[rng.choice(len(unit), min(lists, len(unit)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(unit[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(unit), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres)
    return centres


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _best(who: np.ndarray, at: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of pairs (query, position, score), each query's k best; ties to smaller ids."""
    order = np.lexsort((ids[at], -score, who))
    who, at, score = who[order], at[order], score[order]
    start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.empty(0, np.int64)
    nth = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
    return who[nth < k], at[nth < k], score[nth < k]


def enough_probes(sample: np.ndarray, centres: np.ndarray, k: int, cover: float = COVER) -> int:
    """The fewest lists to probe that hold ``cover`` of the nearest rows, as tried on rows of the sample."""
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(centres)
    own = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(sample), 4096)])
    tried, need = min(TRIED, len(sample)), []
    for i in range(0, tried, 32):
        q = sample[i : min(i + 32, tried)]
        s = q @ sample.T
        s[np.arange(len(q)), i + np.arange(len(q))] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        place = np.empty((len(q), len(centres)), np.int64)
        np.put_along_axis(place, np.argsort(-(q @ centres.T), axis=1, kind="stable"), np.arange(len(centres))[None], 1)
        need.append(np.take_along_axis(place, own[near], 1).ravel() + 1)
    need = np.sort(np.concatenate(need))
    return int(need[min(len(need) - 1, int(np.ceil(cover * len(need))))])


def scan(
    x: np.ndarray, lists: np.ndarray, ids: np.ndarray, queries: np.ndarray, probes: np.ndarray, k: int, turn: np.ndarray,
    bound: np.ndarray | None = None, nearest: np.ndarray | None = None, read: list[int] | None = None,
) -> tuple[np.ndarray, ...]:
    """Query, position and score of the k best rows of ``x`` that the adaptive scan finds for each query.

    lists: the list of each row, ascending; probes: whether a query probes a list (queries x lists).
    bound: a score that is of no use if missed, per query; where it is -inf, rows of the query's
    nearest list (default: the first it probes) give one. read: gets the number of pairs read to the end."""
    n, dims = x.shape
    turned, asked = x @ turn, queries @ turn
    cuts = [*range(0, dims, BLOCK), dims]
    rest_q = [np.sqrt((asked[:, c:] ** 2).sum(1)) for c in cuts]
    bound = np.full(len(queries), -np.inf) if bound is None else bound.copy()
    nearest = probes.argmax(1) if nearest is None else nearest
    unset = np.isneginf(bound)
    starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
    spans = list(zip(starts.tolist(), [*starts[1:].tolist(), n]))
    held, count, exact_ = [tuple(np.empty(0, t) for t in (np.int64, np.int64, float))], 0, 0
    for lo, hi in spans:  # a first bound; these rows are met again below
        who = np.flatnonzero(unset & (nearest == lists[lo]) & probes[:, lists[lo]])
        if len(who) and hi - lo >= k:
            first = queries[who] @ x[lo : min(hi, lo + max(SEEDS, k))].T
            bound[who] = np.partition(first, first.shape[1] - k, axis=1)[:, first.shape[1] - k]
            exact_ += first.size
    often = max(4 * k * len(queries), 20_000)
    for lo, hi in spans:
        rows = np.arange(lo, hi)
        who = np.flatnonzero(probes[:, lists[lo]])
        if not len(who):
            continue
        middle = turned[lo:hi].mean(0)
        off = turned[lo:hi] - middle
        columns = off.T.copy()
        rest_x = [np.sqrt((off[:, c:] ** 2).sum(1)) for c in cuts]
        goal = bound[who] - asked[who] @ middle  # what the part besides the middle's has to reach
        part, alive, pairs = np.zeros((len(who), len(rows))), None, None
        for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if pairs is None:
                part += asked[who, a:b] @ columns[a:b]
            else:
                i, j, p = pairs
                pairs = i, j, p + np.einsum("ij,ij->i", asked[who[i], a:b], off[j, a:b])
            if b == dims:
                break
            f = b / dims
            short = EPSILON * np.sqrt(f * (1 - f) / dims)
            if pairs is None:
                keep = part + np.outer(rest_q[0][who] * short, rest_x[0]) >= f * goal[:, None]
                keep &= part + np.outer(rest_q[c + 1][who], rest_x[c + 1]) >= goal[:, None] - 1e-9
                alive = keep if alive is None else alive & keep
                if alive.mean() < MANY:
                    i, j = np.nonzero(alive)
                    pairs = i, j, part[i, j]
            else:
                i, j, p = pairs
                keep = p + rest_q[0][who[i]] * rest_x[0][j] * short >= f * goal[i]
                keep &= p + rest_q[c + 1][who[i]] * rest_x[c + 1][j] >= goal[i] - 1e-9
                pairs = i[keep], j[keep], p[keep]
        if pairs is None:
            i, j = np.nonzero(alive if alive is not None else np.ones_like(part, bool))
            pairs = i, j, part[i, j]
        i, j, p = pairs
        exact_ += len(i)
        keep = p >= goal[i] - 1e-9
        q, at = who[i[keep]], rows[j[keep]]
        held.append((q, at, (queries[q] * x[at]).sum(1)))
        count += len(q)
        if count > min(HELD, often):
            held = [_best(*(np.concatenate(h) for h in zip(*held)), ids, k)]
            full = np.bincount(held[0][0], minlength=len(queries)) >= k
            worst = np.full(len(queries), np.inf)
            np.minimum.at(worst, held[0][0], held[0][2])
            bound, count = np.where(full, np.maximum(bound, worst), bound), 0
    if read is not None:
        read.append(exact_)
    return _best(*(np.concatenate(h) for h in zip(*held)), ids, k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, cover: float = COVER) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows of ``vectors`` found for each row of
    ``queries`` (other than the row of its own id), by largest inner product.

    Both have vec_id and embedding. cover: the share of nearest rows that the probed lists should hold."""
    spark = vectors.sparkSession
    all_ = stored(entries(usable(vectors), k), "vectors")
    n = all_.count()
    asked = usable(queries)
    if not n:
        empty = all_.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"))
        return empty.withColumn("score", F.lit(0.0)).filter("false")
    lists = int(min(MAX_LISTS, np.ceil(np.sqrt(n))))
    sample = all_.select("x", "id").orderBy(F.xxhash64("id"), "id").limit(max(SAMPLE, PER_LIST * lists)).select("x").toArrow()
    sample = sample["x"].combine_chunks().flatten().to_numpy().reshape(len(sample), -1)
    dims = sample.shape[1]
    centres = fit_centres(sample, lists)
    lists = len(centres)
    probes = enough_probes(sample, centres, k, cover) if cover < 1 else lists
    chunk = int(min(CHUNK, max(LEAST_CHUNK, n // SPREAD)))
    cells = int(min(lists, max(1, n // chunk)))
    cell_of = (centres @ fit_centres(centres, cells).T).argmax(1)
    sent = spark.sparkContext.broadcast((centres, cell_of, rotation(dims)))  # MAX_LISTS and dims rows at most

    def matrix(x) -> np.ndarray:
        return np.array(list(x), np.float64).reshape(len(x), dims)

    def probed(q: np.ndarray, wanted: np.ndarray | None = None):
        """Of blocks of queries: products with the centres, and which of the ``wanted`` lists they probe."""
        for i in range(0, len(q), 1024):
            s = q[i : i + 1024] @ sent.value[0].T
            out = np.zeros(s.shape, bool)
            np.put_along_axis(out, np.argpartition(-s, probes - 1, axis=1)[:, :probes], True, 1)
            yield (s, out) if wanted is None else (s[:, wanted], out[:, wanted])

    @F.pandas_udf("int")
    def list_of(x: pd.Series) -> pd.Series:
        return pd.Series((matrix(x) @ sent.value[0].T).argmax(1).astype(np.int32))

    @F.pandas_udf("array<int>")
    def cells_of(x: pd.Series) -> pd.Series:
        """The cells in which a query probes a list; first that of its nearest list."""
        out = []
        for s, probe in probed(matrix(x)):
            for home, p in zip(sent.value[1][s.argmax(1)], probe):
                reached = np.unique(sent.value[1][p])
                out.append(np.r_[home, reached[reached != home]].astype(np.int32))
        return pd.Series(out)

    indexed = all_.withColumn("list", list_of("x"))
    indexed = stored(indexed, "lists")
    in_list = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}  # a row per list
    rows_in = np.bincount(cell_of, weights=[in_list.get(i, 0) for i in range(lists)], minlength=cells).astype(np.int64)
    chunks = np.maximum(-(-rows_in // (2 * chunk)), 1)
    # one search per distinct query vector, for k + 1, as its own row is among the found
    distinct = stored(asked.groupBy("x").agg(F.min("id").alias("id")).withColumn("cells", cells_of("x")), "queries")
    wanted = k + 1

    def scanned(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not len(rows) or not len(asks):
            return pa.table({"q": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        rows = rows.sort_by("list")
        q, ids = matrix(asks["x"].to_pylist()), rows["id"].to_numpy()
        present, own = np.unique(rows["list"].to_numpy(), return_inverse=True)
        near, probe = (np.concatenate(v) for v in zip(*((s.argmax(1), p) for s, p in probed(q, present))))
        who, at, score = scan(
            matrix(rows["x"].to_pylist()), own, ids, q, probe, wanted, sent.value[2], asks["bound"].to_numpy(), near
        )
        return pa.table({"q": asks["id"].to_numpy()[who], "v": ids[at], "score": score})

    top = W.partitionBy("q").orderBy(F.desc("score"), "v")

    def round_(asks: DataFrame) -> DataFrame:
        """q, v, score of the best rows in the cells that ``asks`` (id, x, bound, cell) names."""
        reached = {r["cell"]: r["count"] for r in asks.groupBy("cell").count().collect()}  # a row per cell
        blocks = np.array([-(-reached.get(i, 0) // ASKED) for i in range(cells)])
        grid = spark.sparkContext.broadcast((cell_of, chunks, blocks))

        @F.pandas_udf("array<long>")
        def tasks_of_row(of: pd.Series, h: pd.Series) -> pd.Series:
            of_list, chunks, blocks = grid.value
            cell = of_list[of.to_numpy()]
            return pd.Series([(c << 40 | v % chunks[c] << 20) + np.arange(blocks[c]) for c, v in zip(cell, h.to_numpy())])

        @F.pandas_udf("array<long>")
        def tasks_of_query(cell: pd.Series, h: pd.Series) -> pd.Series:
            _, chunks, blocks = grid.value
            return pd.Series([(c << 40 | v % blocks[c]) + (np.arange(chunks[c]) << 20) for c, v in zip(cell.to_numpy().astype(np.int64), h.to_numpy())])

        h = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
        placed = indexed.select("id", "x", "list", F.explode(tasks_of_row("list", h)).alias("task"))
        reach = asks.select("id", "x", "bound", F.explode(tasks_of_query("cell", h)).alias("task"))
        near = placed.groupBy("task").cogroup(reach.groupBy("task")).applyInArrow(scanned, "q long, v long, score double")
        return near.withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= wanted).drop("_r")

    nothing = F.lit(float("-inf"))
    near = stored(round_(distinct.select("id", "x", nothing.alias("bound"), F.col("cells")[0].alias("cell"))), "home")
    others = distinct.filter(F.size("cells") > 1)
    if not others.isEmpty():
        worst = near.groupBy(F.col("q").alias("id")).agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_s"))
        worst = worst.select("id", F.when(F.col("_n") == wanted, F.col("_s")).alias("_s"))
        others = others.join(worst, "id", "left").select("id", "x", F.coalesce("_s", nothing).alias("bound"), F.explode("cells").alias("cell"), F.col("cells")[0].alias("_home"))
        others = stored(others.filter("cell <> _home").drop("_home"), "others")
        near = near.unionByName(round_(others))
        near = near.withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= wanted).drop("_r")
    # entries give way to their ids, and query vectors to the queries that have them
    near = near.join(all_.select(F.col("id").alias("v"), "ids"), "v").select("q", "score", F.explode("ids").alias("vec_id"))
    named = asked.distinct().join(distinct.select("x", F.col("id").alias("q")), "x").select("q", F.col("id").alias("query_id"))
    near = near.withColumn("_r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_r") <= wanted)
    found = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("found"))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return (
        named.distinct()
        .join(found, "q")
        .select("query_id", F.posexplode(others).alias("_p", "_f"))
        .select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_f.vec_id").alias("vec_id"), (-F.col("_f.minus")).alias("score"))
    )


def exact(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = 20) -> list[list[tuple[int, float]]]:
    """Brute force over arrays, in blocks of queries; what recall is measured against."""
    out = []
    for i in range(0, len(queries), 256):
        for s, own in zip(queries[i : i + 256] @ vectors.T, query_ids[i : i + 256]):
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != own][:k]
            out.append([(int(ids[j]), float(s[j])) for j in order])
    return out
