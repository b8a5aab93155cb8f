"""Stable identifiers: xxh3, which Spark lacks, over Arrow batches; each distinct text of a batch is hashed once."""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def signed_xxh3(text: str | None) -> int:
    """64-bit xxh3 of the UTF-8 bytes as a signed number; null counts as empty."""
    h = xxhash.xxh3_64_intdigest((text or "").encode("utf-8"))
    return h - (1 << 64) if h >= 1 << 63 else h


def xxh3_64(c: Column) -> Column:
    @pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(texts.fillna(""))
        return pd.Series(pd.Series([signed_xxh3(x) for x in distinct], dtype="int64").to_numpy()[codes] if len(distinct) else [], dtype="int64")

    return hashed(c)


def canonical_json(**parts: Column) -> Column:
    """Compact JSON of texts, nulls as empty."""
    return F.to_json(F.struct(*(F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in parts.items())))
