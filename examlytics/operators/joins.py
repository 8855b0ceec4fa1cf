"""Join helpers with the public names of the inventory."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examlytics.plans.seeds import norm_join
from examlytics.session import stored_bytes


def join_on_norm_key(df: DataFrame, seed: DataFrame, name_col: str, prefix: str = "cw") -> DataFrame:
    """Left join a crosswalk seed on the normalised name (equi-join on a precomputed key; seed broadcast)."""
    return norm_join(df, name_col, seed, prefix)


def keyword_join(tags: DataFrame, vocab: DataFrame, tag_col: str = "tag", keyword_col: str = "keyword") -> DataFrame:
    """Tags x keywords where the lower-cased tag contains the keyword.

    A theta join: the vocabulary is a small literal seed and is broadcast, so
    the plan is a broadcast nested-loop join streaming the tags once.
    """
    return tags.join(F.broadcast(vocab), F.lower(F.col(tag_col)).contains(F.col(keyword_col)), "inner")


def semi_filter(df: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``keys_df`` (left semi join, no duplication)."""
    return df.join(keys_df.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def point_lookup(df: DataFrame, order_by: Sequence[str] = (), **keys: object) -> DataFrame:
    """the one row with the given key values (the first by ``order_by`` descending, then all columns)."""
    cond: Column | None = None
    for k, v in keys.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    rows = df if cond is None else df.where(cond)
    rest = [c for c, t in df.dtypes if c not in order_by and not t.startswith("map")]
    return rows.orderBy(*[F.col(c).desc_nulls_last() for c in order_by], *[F.col(c).asc_nulls_last() for c in rest]).limit(1)


#: Stored (compressed) size up to which a kept dimension is broadcast.
BROADCAST_BYTES = 8 << 20


def as_planned(df: DataFrame, name: str) -> DataFrame:
    """A dimension left to the plan (nothing is written; see :class:`SizedDimensions`)."""
    return df


class SizedDimensions:
    """Keeps deduplicated dimensions as tables and broadcasts those whose stored size is at most ``limit``.

    A fact side then meets a small dimension where it lies; a larger one is
    joined by shuffle, as without the hint. The size is read from the files, so
    the decision rests on a measured bound and not on an estimate.
    """

    def __init__(self, writer: Callable[[DataFrame, str], DataFrame], limit: int = BROADCAST_BYTES):
        self.writer, self.limit = writer, limit

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        kept = self.writer(df, name)
        return F.broadcast(kept) if stored_bytes(kept) <= self.limit else kept


NULL_PARTS = 4096


def spread_nulls(key: str, *spread: str) -> Column:
    """``key`` with NULLs replaced by keys that match nothing, dealt over many partitions by ``spread``.

    All NULL keys would hash to one task, and a NULL key never matches, so a
    left join on this column gives the same rows as one on ``key``; windows
    partitioned by it reuse the join's partitioning.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(NULL_PARTS)).cast("string")
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), part))
