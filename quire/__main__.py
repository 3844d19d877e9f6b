"""``python -m quire FOLDER OUT``: documents below a folder to a Parquet table of path, format, markdown, error.

Exit code 0 if all were read, 1 if some were not, 2 for wrong arguments."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import documents
from .sources import files


def main(argv: list[str]) -> int:
    if len(argv) != 2:
        print(__doc__, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("quire").getOrCreate()
    documents.parse(files.read(spark, argv[0])).write.mode("errorifexists").parquet(argv[1])
    failed = spark.read.parquet(argv[1]).filter(F.col("error").isNotNull()).groupBy("error").count()
    bad = failed.orderBy("error").collect()  # a row per kind of error
    for r in bad:
        print(f"{r['error']}: {r['count']}", file=sys.stderr)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
