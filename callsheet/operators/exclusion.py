"""Exclusion of keys with SQL ``NOT IN`` semantics, without a forced broadcast
of the excluded keys.

``x NOT IN (subquery)`` is UNKNOWN for every ``x`` as soon as the subquery
returns one NULL, so the whole result is empty; and ``NULL NOT IN (set)`` is
UNKNOWN unless the set is empty.  Spark plans a single-key ``NOT IN`` as a
null-aware broadcast hash join, whatever the size of the subquery.  Here the
same result is an ordinary ``left_anti`` on the keys (shuffled when large)
plus a per-portfolio flag table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_keys(df: DataFrame, excluded: DataFrame, key: str = "nmcont", scope: str = "cod_cli",
                 null_aware: bool = True, df_keys_not_null: bool = False,
                 poison: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose (``scope``, ``key``) is not in ``excluded``.

    ``null_aware=True`` reproduces ``key NOT IN (SELECT key ... WHERE scope = df.scope)``:
    a NULL ``key`` in ``excluded`` removes every row of that scope, and a
    NULL ``key`` in ``df`` survives only when its scope excludes nothing
    (``df_keys_not_null=True`` skips that branch when ``df`` cannot have one).
    The flag table has one row per scope value; both joins are left to the
    planner, which broadcasts by measured size.
    """
    keys = [scope, key]
    kept = df.join(excluded.filter(F.col(key).isNotNull()).select(*keys).distinct(), keys, "left_anti")
    if not null_aware:
        return kept
    if df_keys_not_null:
        # only the poison rule applies; the NULL-key filter reaches the scan.
        # ``poison`` may be given precomputed (scopes with a NULL excluded key).
        if poison is None:
            poison = excluded.filter(F.col(key).isNull()).select(scope).distinct()
        return kept.join(poison, scope, "left_anti")
    flags = excluded.groupBy(scope).agg(
        F.max(F.col(key).isNull()).alias("_poisoned"),
        F.lit(True).alias("_nonempty"),
    )
    joined = kept.join(flags, scope, "left")
    keep = ~F.coalesce(F.col("_poisoned"), F.lit(False)) & (
        F.col(key).isNotNull() | ~F.coalesce(F.col("_nonempty"), F.lit(False))
    )
    return joined.filter(keep).drop("_poisoned", "_nonempty")
