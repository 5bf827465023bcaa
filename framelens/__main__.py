"""python -m framelens QUERY sf_dir=... [limit=20] [out=path]: runs a registered query and shows or writes its rows."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .config import from_words
from .plans.catalog import QUERIES

DEFAULTS = {"sf_dir": "/root/testdata/sf0.01", "limit": 20, "out": None, "explain": False}


def main(words: list[str]) -> int:
    if not words or words[0] not in QUERIES:
        print(__doc__, "\n\nQueries:", *sorted(QUERIES))
        return 2
    settings = from_words(DEFAULTS, words[1:])
    spark = SparkSession.builder.getOrCreate()
    df = QUERIES[words[0]](spark, settings["sf_dir"])
    if settings["explain"]:
        df.explain("formatted")
    elif settings["out"]:
        df.write.mode("overwrite").parquet(settings["out"])
    else:
        df.show(settings["limit"], truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
