"""Fixity audit of WARC replicas with Merkle trees.

A record's leaf is the SHA-256 of its bytes. Leaves are put into ranges of ``RANGE``
bytes of offset in their file; a range's node is the hash of its leaves in order of
offset, and above ranges, nodes of ``1 << FANOUT_BITS`` children each lead to a file's node,
and from there to a root. Every level is an aggregation of the level below, which is
smaller by the fan-out, and a node's children are few, so nothing is gathered in one place
but the root.

``audit`` compares two trees from the root: children are joined only below nodes that
differ, so equal branches are never opened. A record that was lost, put in or resized
moves those behind it in its file; in the ranges that differ, records are therefore
aligned by identity (file, page_id) and bytes, and only those are named that have no
equal: changed, missing or extra.

``leaves`` computes the layout and the digests from a table of pages, without shuffling
any bytes of a page. ``write_archive`` writes the same layout as WARC files and
``read_archive`` reads leaves from such files, record by record.

Defined cases. Null html or url: empty. Null page_id: in one of 4096 files below zero, by
digest. Records of equal id lie in order of their digest; repeated records at offsets of
their own. What cannot be read as a record, to the end of its file, is one record without
id. Two empty archives are equal. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import stored

RANGE, FANOUT_BITS, FILE_RECORDS, ID_LESS_FILES = 1 << 16, 4, 512, 4096
RANGE_BITS = 24  # of a range's number in its file
COPIES, READ = 4096, 1 << 20
FORM = "file long, offset long, length long, page_id long, digest string"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """One WARC resource record, as bytes."""
    html = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    ).cast("binary")


def _placed(pages: DataFrame) -> DataFrame:
    """file, page_id, digest, record of every page."""
    page_id = F.col("page_id").cast("long")
    r = pages.select(page_id.alias("page_id"), record(page_id, F.col("url"), F.col("html")).alias("record"))
    r = r.withColumn("digest", F.sha2("record", 256))
    bucket = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % ID_LESS_FILES
    return r.select(F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), -1 - bucket).cast("long").alias("file"), "page_id", "digest", "record")


def leaves(pages: DataFrame) -> DataFrame:
    """file, offset, length, page_id, digest of every page's record.

    Equal records are counted before anything is shuffled, and have one place in the running sum."""
    rows = _placed(pages).select("file", "page_id", "digest", F.octet_length("record").cast("long").alias("length"))
    runs = rows.groupBy("file", "page_id", "digest", "length").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("file").orderBy("page_id", "digest").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("start", F.coalesce(F.sum(F.col("length") * F.col("n")).over(order), F.lit(0)))
    runs = runs.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    runs = runs.withColumn("i", F.explode(F.sequence("lo", F.least(F.col("lo") + COPIES, F.col("n")) - 1)))
    return runs.select("file", (F.col("start") + F.col("i") * F.col("length")).cast("long").alias("offset"), "length", "page_id", "digest")


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a WARC file ``<file>.warc`` per file into ``folder``, which all machines share, in the
    layout of ``leaves``; file, records and bytes of each. A file is renamed when it is whole, so a
    repeated task leaves the same file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _file_system(folder)
        system.create_dir(at, recursive=True)
        now = out = part = None
        n = size = 0

        def done():
            out.close()
            system.move(part, f"{at}/{now}.warc")
            return pa.RecordBatch.from_pydict({"file": [now], "records": [n], "bytes": [size]})

        for b in batches:
            for file, bytes_ in zip(b.column(0).to_pylist(), b.column(1)):
                if file != now:
                    if out is not None:
                        yield done()
                    now, n, size = file, 0, 0
                    part = f"{at}/.{uuid.uuid4().hex}"
                    out = system.open_output_stream(part)
                data = bytes_.as_buffer()
                out.write(data)
                n, size = n + 1, size + data.size
        if out is not None:
            yield done()

    rows = _placed(pages).repartition("file").sortWithinPartitions("file", "page_id", "digest").select("file", "record")
    return stored(rows.mapInArrow(run, "file long, records long, bytes long"), "written")


_ID = re.compile(rb"^WARC-Record-ID: *<urn:page:(-?\d+)>\s*$", re.I | re.M)
_LENGTH = re.compile(rb"^Content-Length: *(\d+)\s*$", re.I | re.M)


def records(stream) -> Iterator[tuple[int, int, int | None, str]]:
    """offset, length, page_id, digest of each record of a WARC stream, which is read in blocks."""
    held, at, digest = b"", 0, hashlib.sha256()

    def fill(n: int) -> bool:
        nonlocal held
        while len(held) < n and (more := stream.read(READ)):
            held += more
        return len(held) >= n

    def take(n: int) -> int:
        """Hashes the next n bytes in blocks; how many there were."""
        nonlocal held
        left = n
        while left and (held or fill(1)):
            some, held = held[:left], held[left:]
            digest.update(some)
            left -= len(some)
        return n - left

    while fill(1):
        digest = hashlib.sha256()
        size = 1 << 12
        while (end := held.find(b"\r\n\r\n")) < 0 and len(held) < READ and fill(size):
            size *= 2
        if end < 0:
            end = held.find(b"\r\n\r\n")
        head = held[: end + 2] if end >= 0 else b""
        length = _LENGTH.search(head)
        if not head.startswith(b"WARC/") or length is None:  # no record: all the rest
            n = 0
            while got := take(READ):
                n += got
            yield at, n, None, digest.hexdigest()
            return
        found = _ID.search(head)
        n = take(end + 4 + int(length[1]) + 4)
        yield at, n, int(found[1]) if found else None, digest.hexdigest()
        at += n


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves of the WARC files ``<file>.warc`` in ``folder``; a task reads whole files, in blocks."""
    system, at = _file_system(folder)
    from pyarrow import fs

    names = [x.base_name for x in system.get_file_info(fs.FileSelector(at)) if x.base_name.endswith(".warc")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _file_system(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                file, rows = int(os.path.splitext(name)[0]), []
                with system.open_input_stream(f"{at}/{name}") as f:
                    for r in records(f):
                        rows.append((file, *r))
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    files = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    return files.repartition(max(1, min(len(names), 10_000))).mapInArrow(run, FORM)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["file", "offset", "length", "page_id", "digest"])


def _parents(nodes: DataFrame, parent: Column) -> DataFrame:
    inside = F.array_sort(F.collect_list(F.struct("node", "digest")))
    joined = F.array_join(F.transform(inside, lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"])), "\n")
    return nodes.groupBy(parent.alias("parent")).agg(F.sha2(joined, 256).alias("digest"))


def _range_of() -> Column:
    return F.col("file") * (1 << RANGE_BITS) + F.floor(F.col("offset") / RANGE)


def tree(leaf: DataFrame, inner: int, top: int) -> list[DataFrame]:
    """The levels, root first: node, parent, digest. ``inner``: levels between ranges and files; ``top``: above files.

    A node below files is file << RANGE_BITS | number in the file; a leaf counts by its order in its range, not its offset."""
    place = F.row_number().over(W.partitionBy("p").orderBy("offset"))
    ordered = leaf.select(_range_of().alias("p"), "offset", "digest").withColumn("node", place)
    up = _parents(ordered, F.col("p"))
    steps = [(1 << RANGE_BITS, True)] * inner + [(1 << RANGE_BITS, False)] + [(1 << FANOUT_BITS, False)] * top
    levels = []
    for width, within in steps:
        n = F.col("parent")
        file = F.floor(n / width)
        parent = file * width + F.floor(F.pmod(n, F.lit(width)) / (1 << FANOUT_BITS)) if within else file
        levels.append(stored(up.select(n.alias("node"), parent.cast("long").alias("parent"), "digest"), "tree"))
        up = _parents(levels[-1], F.col("parent"))
    levels.append(stored(up.select(F.col("parent").alias("node"), F.lit(0).cast("long").alias("parent"), "digest"), "tree"))
    return levels[::-1]


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """file, page_id, state (changed, missing, extra), offset, replica_offset of records in which two ``leaves`` tables differ."""
    primary, replica = stored(primary, "leaves"), stored(replica, "leaves")
    both = primary.select("file", "offset").union(replica.select("file", "offset"))
    most = both.agg(F.max(F.abs("file")), F.max(F.floor(F.col("offset") / RANGE))).first()
    if (most[1] or 0) >= 1 << RANGE_BITS:
        raise ValueError(f"a file has at most {RANGE << RANGE_BITS} bytes")
    inner, top = (max(1, -(-int((m or 0) + 1).bit_length() // FANOUT_BITS)) for m in (most[1], most[0]))
    ours, theirs = tree(primary, inner, top), tree(replica, inner, top)
    wrong = None
    for a, b in zip(ours, theirs):
        a = a.select("node", "parent", F.col("digest").alias("ours"))
        b = b.select("node", F.col("parent").alias("_p"), F.col("digest").alias("theirs"))
        if wrong is not None:
            a = a.join(wrong.withColumnRenamed("node", "parent"), "parent", "left_semi")
            b = b.join(wrong.withColumnRenamed("node", "_p"), "_p", "left_semi")
        wrong = stored(a.join(b, "node", "full").filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select("node"), "wrong")
        if wrong.isEmpty():
            break
    return _aligned(*(x.withColumn("node", _range_of()).join(wrong, "node", "left_semi").drop("node") for x in (primary, replica)))


def _aligned(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records of two sides that have no equal on the other, the k-th of an id with the k-th."""

    def numbered(x: DataFrame, by: list[str], name: str) -> DataFrame:
        """by, the place among rows that agree in them, and the offset under ``name``."""
        return x.select(*by, F.row_number().over(W.partitionBy(*by).orderBy("offset")).alias("k"), F.col("offset").alias(name))

    def joined(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
        b = b.select(*(F.col(c).alias(f"_{c}") for c in [*by, "k"]), "theirs")
        same = F.lit(True)
        for c in [*by, "k"]:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = a.join(b, same, "full")
        own = F.col("ours").isNotNull()
        return out.select(*(F.when(own, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in by), "ours", "theirs")

    exact, loose = ["file", "page_id", "digest"], ["file", "page_id"]
    alone = joined(numbered(primary, exact, "ours"), numbered(replica, exact, "theirs"), exact)
    alone = stored(alone.filter("ours IS NULL OR theirs IS NULL"), "alone")
    a, b = (alone.filter(f"{n} IS NOT NULL").select(*loose, F.col(n).alias("offset")) for n in ("ours", "theirs"))
    out = joined(numbered(a, loose, "ours"), numbered(b, loose, "theirs"), loose)
    state = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
    return out.select("file", "page_id", state.alias("state"), F.col("ours").alias("offset"), F.col("theirs").alias("replica_offset"))
