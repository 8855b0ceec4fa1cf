"""Keep-latest deduplication.

``row_number() over (partition by key order by ...) = 1`` is planned by
Catalyst as a partial WindowGroupLimit before the shuffle and a final one
after it, so each map task already keeps one row per key: a key with very
many snapshots is reduced before it reaches the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    out = []
    for o in order:
        out.append(F.col(o).desc_nulls_last() if isinstance(o, str) else o)
    return out


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str] = ("load_date",),
                 pre_filter: Column | None = None,
                 tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (strings mean DESC NULLS LAST).

    ``pre_filter`` is applied *before* ranking (it changes which row is
    latest, so it is not pushed through the window). Ties on ``order`` are
    broken by ``tiebreak`` ascending (default: every other column), which
    makes the pick deterministic under any partitioning.
    """
    if pre_filter is not None:
        df = df.where(pre_filter)
    ordering = _order_cols(order)
    if tiebreak is None:
        used = set(keys) | {o for o in order if isinstance(o, str)}
        tiebreak = [c for c in df.columns if c not in used]
    ordering += [F.col(c).asc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
