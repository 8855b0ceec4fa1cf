"""Lake layout readers and writers, catalog registration, ad-hoc access
(SRC6-SRC15).

Layout: ``<root>/<database>/<Table>/load_date=YYYY-MM-DD/part-*.parquet``.
``load_date`` is kept as text (partition type inference is off in the
session), so "latest" is a lexical maximum, as in the source.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from examlytics.sources.commits import folder_names

# Catalog prefixes per source system (two systems both have an
# AssessmentTaker table; the prefix keeps them apart).
DEFAULT_PREFIXES = {"test_creation": "test_creation", "test_execution": "test_execution",
                    "user_mgt": "user_mgt"}
VIEW_READ_LIMIT = 50_000


def table_path(root: str, database: str, table: str) -> str:
    return f"{root.rstrip('/')}/{database}/{table}"


def latest_snapshot(df: DataFrame, partition_col: str = "load_date") -> DataFrame:
    """Rows of the newest ``load_date`` (scalar subquery on the partition column).

    On a partitioned file source the filter becomes a partition filter, so
    only the newest partition's files are read.
    """
    latest = df.agg(F.max(partition_col)).scalar()
    return df.where(F.col(partition_col) == latest)


def listed_partitions(df: DataFrame, partition_col: str) -> set[str]:
    """Values of a partition column by the file listing (no file is opened)."""
    found = (re.search(f"/{re.escape(partition_col)}=([^/]+)/", f) for f in df.inputFiles())
    return {unquote(m[1]) for m in found if m}


def read_latest(spark: SparkSession, root: str, database: str, table: str) -> tuple[str, DataFrame]:
    """SRC7: (latest load_date, its rows). FileNotFoundError when there is none."""
    path = table_path(root, database, table)
    try:
        df = spark.read.option("basePath", path).parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no load_date partitions under {path}") from exc
    if "load_date" not in df.columns:
        raise FileNotFoundError(f"no load_date partitions under {path}")
    latest = max(listed_partitions(df, "load_date"), default=None)
    if latest is None:
        raise FileNotFoundError(f"partition exists but no parquet files under {path}")
    return latest, df.where(F.col("load_date") == latest)


def write_snapshot(df: DataFrame, root: str, database: str, table: str, load_date: str,
                   idempotent: bool = False) -> str:
    """SRC8/SRC9: write one ``load_date`` snapshot.

    ``idempotent=False`` appends (a same-day rerun adds a second copy, as the
    source code does); ``idempotent=True`` replaces only that load_date
    partition (dynamic partition overwrite, the documented intent).
    """
    path = table_path(root, database, table)
    out = df.drop("load_date").withColumn("load_date", F.lit(load_date))
    w = out.write.partitionBy("load_date").option("compression", "snappy")
    if idempotent:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)
    return f"{path}/load_date={load_date}"


def write_bronze(df: DataFrame, root: str, table: str, date: str) -> str:
    """SRC6: append a batch under ``table=<t>/date=<d>`` (Snappy Parquet)."""
    path = f"{root.rstrip('/')}/table={table}"
    (df.withColumn("date", F.lit(date)).write.partitionBy("date").mode("append")
     .option("compression", "snappy").parquet(path))
    return f"{path}/date={date}"


def write_lookup(df: DataFrame, path: str, cluster: Sequence[str], bloom: Sequence[str] = (), row_group_bytes: int = 1 << 23) -> DataFrame:
    """A copy laid out for point lookups; returns it as read back.

    Rows are hashed and sorted by ``cluster``, so equal keys are neighbours and
    a row group spans few of them; each ``bloom`` column gets Parquet bloom
    filters, so a lookup by another key skips the row groups without it. Both
    work through plain equality filters: no index has to be named by a reader.
    """
    w = df.repartition(*cluster).sortWithinPartitions(*cluster).write.option("parquet.block.size", row_group_bytes)
    for c in dict.fromkeys([*cluster, *bloom]):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_dataset(spark: SparkSession, root: str, name: str, legacy_prefixes: Sequence[str] = (),
                 schema: StructType | None = None) -> DataFrame:
    """SRC10: a gold dataset (all partitions); legacy locations tried in order;
    an empty frame (with ``schema`` when given) when nothing exists."""
    for prefix in [""] + list(legacy_prefixes):
        path = f"{root.rstrip('/')}/{prefix + '/' if prefix else ''}{name}"
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            continue
    return spark.createDataFrame([], schema or StructType([]))


#: Integer and floating types from narrow to wide; a mixture of both becomes double.
_INTEGERS, _FLOATS = ("tinyint", "smallint", "int", "bigint"), ("float", "double")


def common_type(kinds: Iterable[str]) -> str:
    """The type that holds the values of all given ones: the widest number, text if nothing else does."""
    kinds = set(kinds)
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= set(_INTEGERS):
        return max(kinds, key=_INTEGERS.index)
    if kinds <= {*_INTEGERS, *_FLOATS}:
        return "double"
    if kinds <= {"date", "timestamp"}:
        return "timestamp"
    return "string"


def read_reconciled(spark: SparkSession, path: str, partition_col: str = "load_date") -> DataFrame:
    """SRC10 over drifting snapshots: partitions that disagree in columns or types, read as one table.

    The schema of each partition comes from its files' footers; columns are
    united (missing ones are NULL) and types widened by :func:`common_type`.
    Partitions of equal schema are read together, so the plan has one scan per
    distinct schema, and each file is read with its own types before the cast.
    """
    prefix = f"{partition_col}="
    parts = [n for n in folder_names(spark, path) if n.startswith(prefix)]
    if not parts:
        raise FileNotFoundError(f"no {partition_col} partitions under {path}")
    groups: dict[str, list[str]] = {}
    for n in parts:
        schema = spark.read.option("mergeSchema", True).parquet(f"{path}/{n}").schema
        groups.setdefault(schema.json(), []).append(f"{path}/{n}")
    schemas = {j: StructType.fromJson(json.loads(j)) for j in groups}
    kinds: dict[str, set[str]] = {}
    for schema in schemas.values():
        for f in schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    frames = []
    for j, paths in groups.items():
        own = schemas[j].add(partition_col, "string")
        df = spark.read.schema(own).option("basePath", path).parquet(*paths)
        frames.append(df.select(*[(F.col(c) if c in schemas[j].names else F.lit(None)).cast(common_type(k)).alias(c) for c, k in kinds.items() if c != partition_col],
                                partition_col))
    return reduce(DataFrame.unionByName, frames)


def register_silver(spark: SparkSession, root: str, tables: Mapping[str, Sequence[str]],
                    prefixes: Mapping[str, str] = DEFAULT_PREFIXES) -> list[str]:
    """SRC11: register ``<prefix>_<table lower>`` temp views over the lake.

    ``tables`` maps a database directory to its table directories. Every
    view spans all snapshots (the views deduplicate).
    """
    names = []
    for db, tbls in tables.items():
        prefix = next((p for k, p in prefixes.items() if k in db), db)
        for t in tbls:
            path = table_path(root, db, t)
            view = f"{prefix}_{t.lower()}"
            spark.read.option("basePath", path).parquet(path).createOrReplaceTempView(view)
            names.append(view)
    return names


def query_view(spark: SparkSession, name: str, limit: int | None = VIEW_READ_LIMIT,
               order_by: Sequence[str] = ()) -> DataFrame:
    """SRC12: ``SELECT * FROM view [ORDER BY ...] [LIMIT n]`` (the limit is the feature)."""
    df = spark.table(name)
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit) if limit else df


def run_sql(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """SRC13: ad-hoc SQL with named parameters (never string splicing)."""
    return spark.sql(sql, args=dict(args or {}))


_IDENT = re.compile(r"^[a-zA-Z_][a-zA-Z0-9_]*$")


def infer_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """SRC14: cast text columns whose every non-blank value parses as a number.

    One aggregate pass counts, per column, the non-blank values and those
    that parse; only the per-column counts reach the driver.
    """
    cols = [c for c in (columns or df.columns) if dict(df.dtypes)[c] == "string"]
    if not cols:
        return df
    aggs = []
    for i, c in enumerate(cols):
        v = F.trim(F.col(c))
        aggs += [F.count_if(v.isNotNull() & (v != "")).alias(f"n{i}"),
                 F.count_if(v.try_cast("double").isNotNull()).alias(f"p{i}")]
    stats = df.agg(*aggs).first()
    numeric = {c for i, c in enumerate(cols) if stats[f"n{i}"] > 0 and stats[f"n{i}"] == stats[f"p{i}"]}
    return df.select(*[F.trim(F.col(c)).try_cast("double").alias(c) if c in numeric else F.col(c)
                       for c in df.columns])


def export_csv(df: DataFrame, path: str) -> str:
    """SRC15: CSV with a header row (one file per partition)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
