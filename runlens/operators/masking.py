"""Column masking as a projection (open-source Spark has no masking
policies on tables; a masked view or DataFrame plays that role)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("mask", "hash", "null")


def masked_view(df: DataFrame, policies: dict[str, str]) -> DataFrame:
    """Apply a policy per column: 'mask' (letters/digits replaced, as
    ``mask()``), 'hash' (SHA-256 hex) or 'null'. Other columns pass through."""
    unknown = {c: p for c, p in policies.items() if p not in POLICIES}
    if unknown:
        raise ValueError(f"unknown masking policies: {unknown}")
    missing = [c for c in policies if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the frame: {missing}")
    out = []
    for c in df.columns:
        p = policies.get(c)
        col = F.col(c)
        if p == "mask":
            col = F.mask(col.cast("string"))
        elif p == "hash":
            col = F.sha2(col.cast("string"), 256)
        elif p == "null":
            col = F.lit(None).cast(df.schema[c].dataType)
        out.append(col.alias(c))
    return df.select(*out)
