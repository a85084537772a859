"""Helpers shared by the text operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documented default place of the public vocabularies; every operator takes another path.
TOKENIZERS = "/opt/tokenizers"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file: the installed package's, else ``TOKENIZERS``."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


class BoundedCache(dict):
    """A dict that computes missing values and starts anew once it holds ``most`` entries."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def slices(batch, rows: int):
    """Parts of an Arrow batch, so that texts of one part at a time are Python objects."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
