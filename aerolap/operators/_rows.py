"""Row selection on a computed flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, flag: str) -> DataFrame:
    """Rows of ``df`` whose computed boolean column ``flag`` is true (dropped).

    Catalyst pushes a filter on a computed column below the projection that
    computes it, inlining the expression into the filter, and filters get no
    common-subexpression elimination: a flag built from many shared parts
    (seven time checks over the same clock conversions) would then be
    evaluated piece by piece many times per row. Reading the flag through a
    one-element ``inline`` generator keeps the filter above that projection,
    where the parts are shared; it stays in the same codegen stage.
    """
    cols = [c for c in df.columns if c != flag]
    return (
        df.select(*cols, F.inline(F.array(F.struct(F.col(flag).alias("_keep")))))
        .filter(F.col("_keep"))
        .drop("_keep")
    )
