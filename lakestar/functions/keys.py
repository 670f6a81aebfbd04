"""Reproducible surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str) -> Column:
    """md5 over the parts; a NULL part counts as empty text, so keys never vanish."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *texts))
