"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas: an insert
adds a document and its tokens, a delete takes them away, a revision adds the
difference of the counts. A tokenizer version is a vocabulary of byte-level BPE; counts
per document are kept beside the totals (``token_counts``, written once), so that deletes
and revisions read the old counts and texts are never counted twice.

Each batch is aggregated and written to a folder of its own, which is then renamed to the
batch id: a batch is there whole or not at all, and of one id only the first counts.
``compact`` folds complete batches into one, which names in a file of its own what it
folds, and is renamed as a whole; from then on readers leave out what it names. Folded
folders are removed afterwards. A crash at any point leaves either the old batches or the
new one in force.

Defined cases. Null text: 0 tokens. Null source, language or tokenizer: groups of their
own. Null counts: 0. Groups without documents and tokens leave the totals. Repeated
rows each count. Empty batch: no change. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
#: Tokenizer versions: vocabulary files of byte-level BPE, in the installed package.
TOKENIZERS = {"bpe-50k": "byte_bpe_50k.tiktoken", "bpe-multi-50k": "byte_bpe_multi_50k.tiktoken"}
SLICE = 256


@lru_cache(maxsize=4)
def _encoding(name: str):
    import public_tokenizers
    import tiktoken

    from .bpe import load_ranks

    ranks = load_ranks(public_tokenizers.path(TOKENIZERS[name]))
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens: a row per document and tokenizer version.

    Texts are counted whole by the public library, with the vocabularies of ``TOKENIZERS``."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = [_encoding(n) for n in TOKENIZERS]
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                texts = [t or "" for t in part.column(3).to_pylist()]
                n = np.array([[len(e.encode_ordinary(t)) for e in each] for t in texts], np.int64).reshape(len(texts), len(each))
                index = pa.array(np.repeat(np.arange(part.num_rows), len(each)))
                columns = [part.column(i).take(index) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(list(TOKENIZERS) * part.num_rows), pa.array(n.ravel())], ["doc_id", *KEYS, "tokens"]
                )

    plain = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return plain.mapInArrow(run, f"doc_id {kind}, source string, lang string, tokenizer string, tokens bigint")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return inserts(counts).select(*KEYS, (-F.col("documents")).alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows of counts that give way to others; a document may change its source or language too."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """Totals in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(sc._jsc.hadoopConfiguration()), lambda p: sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")

    def _names(self, fs, at) -> tuple[list[str], set[str], list[str]]:
        """Folders of batches; ids that they fold; folders in force."""
        if not fs.exists(at("")):
            return [], set(), []
        names = sorted(s.getPath().getName() for s in fs.listStatus(at("")) if s.getPath().getName().startswith("batch="))
        folded: set[str] = set()
        for n in names:
            if n.startswith("batch=compact-"):
                lines = self.spark.read.text(f"{self.path}/{n}/folds").collect()
                folded.update(json.loads(r[0]) for r in lines)
        return names, folded, [n for n in names if n not in folded]

    def batches(self) -> list[str]:
        """Folders in force."""
        return self._names(*self._fs())[2]

    def _placed(self, fs, at, sums: DataFrame, name: str, folds: list[str] | None = None) -> None:
        """Writes beside the target and renames; if the target is there already, it stays."""
        part = f"_part-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{part}/sums")
        if folds is not None:
            rows = self.spark.createDataFrame([(json.dumps(f),) for f in folds], "value string")
            rows.coalesce(1).write.text(f"{self.path}/{part}/folds")
        if fs.exists(at(name)) or not fs.rename(at(part), at(name)):
            fs.delete(at(part), True)

    def commit(self, batch: str, deltas: DataFrame) -> None:
        """Adds a batch of signed rows; of one id, only the first counts, however often it is committed."""
        fs, at = self._fs()
        names, folded, _ = self._names(fs, at)
        if f"batch={batch}" in names or f"batch={batch}" in folded:
            return
        self._placed(fs, at, self._sums(deltas), f"batch={batch}")

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def _totals(self, names: list[str]) -> DataFrame:
        form = "source string, lang string, tokenizer string, documents long, tokens long"
        paths = [f"{self.path}/{n}/sums" for n in names]
        rows = self.spark.read.schema(form).parquet(*paths) if paths else self.spark.createDataFrame([], form)
        return self._sums(rows).filter("documents <> 0 OR tokens <> 0")

    def totals(self) -> DataFrame:
        return self._totals(self.batches())

    def compact(self, name: str) -> None:
        """Folds the batches in force into one named ``compact-name``."""
        fs, at = self._fs()
        names, folded, live = self._names(fs, at)
        if f"batch=compact-{name}" not in names and live:
            # what was folded before stays known, so that late repetitions are still ignored
            self._placed(fs, at, self._totals(live), f"batch=compact-{name}", sorted(folded.union(live)))
        names, folded, _ = self._names(fs, at)
        for n in folded.intersection(names):
            fs.delete(at(n), True)
