"""Incremental keep-latest: one bucketed state table that takes one load at a time.

Keep-latest over all snapshots shuffles every snapshot of every key again on
each run. :class:`LatestState` keeps the picked row per key in a table bucketed
by the key, and merges a new load into it: only the load is shuffled, into the
state's own buckets; the state is read bucket by bucket without an exchange and
written back the same way. The pick is a total order (``order`` descending,
NULLs last, then the other columns ascending, NULLs last, as in
:func:`examlytics.operators.dedup.dedup_latest`), so merging loads in any order,
or one load twice, ends in the pick over all snapshots.

Every merge writes a new version beside the old one and then commits it
(:class:`examlytics.sources.commits.CommitLog`), so a crash leaves the last
committed state readable; :meth:`LatestState.vacuum` deletes older versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examlytics.operators.dedup import dedup_latest
from examlytics.sources.commits import CommitLog, delete_folder

KEY = "__key"


def key_text(keys: Sequence[str]) -> Column:
    """One non-NULL text per key; NULL parts differ from every value."""
    return F.to_json(F.struct(*keys))


def comes_first(order: Sequence[str], tiebreak: Sequence[str]) -> Column:
    """Whether struct ``new`` precedes struct ``old`` in keep-latest order."""
    def beats(name: str, down: bool) -> tuple[Column, Column]:
        new, old = F.col(f"new.{name}"), F.col(f"old.{name}")
        ahead = (new > old) if down else (new < old)
        wins = F.coalesce(ahead, new.isNotNull() & old.isNull())
        return wins, ~wins & ~new.eqNullSafe(old)

    steps = [beats(o, True) for o in order] + [beats(t, False) for t in tiebreak]
    return reduce(lambda rest, step: F.when(step[0], F.lit(True)).when(step[1], F.lit(False)).otherwise(rest), reversed(steps), F.lit(False))


class LatestState:
    """Latest row per key under ``root`` (a folder that all executors share).

    ``pre_filter`` is applied to a load before the pick, as in the batch form.
    Opening a root that has commits continues from the last one.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] = ("load_date",),
                 pre_filter: Column | None = None, buckets: int | None = None, tiebreak: Sequence[str] | None = None):
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), list(keys), list(order)
        self.pre_filter, self.tiebreak = pre_filter, tiebreak
        self.log = CommitLog(spark, self.root)
        last = self.log.last()
        self.buckets = int(last["buckets"]) if last else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table: str | None = None
        if last:
            self.table = f"latest_{uuid.uuid4().hex}"
            spark.sql(f"CREATE TABLE {self.table} ({last['schema']}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {self.buckets} BUCKETS LOCATION '{last['path']}'")

    def _picked(self, load: DataFrame) -> DataFrame:
        load = load.where(self.pre_filter) if self.pre_filter is not None else load
        load = load.withColumn(KEY, key_text(self.keys))
        used = {KEY, *self.keys, *self.order}
        picked = dedup_latest(load, keys=[KEY], order=self.order, tiebreak=self._tiebreak([c for c in load.columns if c not in used]))
        return picked.repartition(self.buckets, KEY)  # as many partitions as the state, so that the state stays where it is

    def _tiebreak(self, others: Sequence[str]) -> list[str]:
        return list(others if self.tiebreak is None else self.tiebreak)

    def merged(self, load: DataFrame) -> DataFrame:
        """The next state, with the key column (lazy)."""
        new = self._picked(load)
        if self.table is None:
            return new
        state = self.spark.table(self.table)
        cols = [c for c in state.columns if c != KEY]
        pair = state.select(F.col(KEY).alias("k"), F.struct(*cols).alias("old")).join(
            new.select(F.col(KEY).alias("n"), F.struct(*cols).alias("new")), F.col("k") == F.col("n"), "full_outer")
        tiebreak = self._tiebreak([c for c in cols if c not in {*self.keys, *self.order}])
        take_new = F.col("old").isNull() | (F.col("new").isNotNull() & comes_first(self.order, tiebreak))
        return pair.select(F.coalesce("k", "n").alias(KEY), F.when(take_new, F.col("new")).otherwise(F.col("old")).alias("row")).select(KEY, "row.*")

    def merge(self, load: DataFrame) -> DataFrame:
        """Take one load; returns the new state."""
        table, path = f"latest_{uuid.uuid4().hex}", f"{self.root}/state-{uuid.uuid4().hex}"
        out = self.merged(load)
        out.write.format("parquet").bucketBy(self.buckets, KEY).sortBy(KEY).option("path", path).option("compression", "zstd").saveAsTable(table)
        self.log.commit(path=path, buckets=str(self.buckets), schema=", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields))
        if self.table is not None:
            self.spark.sql(f"DROP TABLE {self.table}")  # the catalog entry; files stay until vacuum
        self.table = table
        return self.current()

    def current(self) -> DataFrame:
        """The latest row of every key."""
        if self.table is None:
            raise ValueError(f"no load was merged into {self.root}")
        return self.spark.table(self.table).drop(KEY)

    def vacuum(self) -> None:
        """Delete the files of older versions."""
        paths = [c["path"] for c in self.log.all()]
        for p in paths[:-1]:
            delete_folder(self.spark, p)

    def drop(self) -> None:
        """Delete the state."""
        if self.table is not None:
            self.spark.sql(f"DROP TABLE {self.table}")
            self.table = None
        delete_folder(self.spark, self.root)


def merge_loads(spark: SparkSession, root: str, snapshots: DataFrame, keys: Sequence[str], order: Sequence[str] = ("load_date",),
                pre_filter: Column | None = None, partition_col: str = "load_date") -> LatestState:
    """Merge the loads of a snapshot table one after another, oldest first (one row per load reaches the driver)."""
    state = LatestState(spark, root, keys, order, pre_filter)
    for (load,) in sorted(snapshots.select(partition_col).distinct().collect()):
        state.merge(snapshots.where(F.col(partition_col) == load))
    return state
