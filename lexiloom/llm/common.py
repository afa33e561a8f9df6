"""What several of the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_version(df: DataFrame, loaded_at: str = "loaded_at") -> DataFrame:
    """``df`` with ``__version``: orders the rows of an id; the valid row has the greatest.

    The load time decides (null is earliest).  Rows of the same time that differ are ordered by a
    digest of their content, so that the choice does not depend on the order of reading.
    """
    return df.withColumn("__version", F.struct(F.col(loaded_at).alias("at"), F.xxhash64(*[F.col(c) for c in df.columns if c != loaded_at]).alias("digest")))
