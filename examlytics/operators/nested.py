"""JSON text, arrays and reshaping.

All parsing is native (``from_json`` / VARIANT); explode is the lateral
``CROSS JOIN UNNEST`` (rows with empty arrays disappear).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_tags(text: ColumnOrName) -> Column:
    """JSON text -> ``array<string>``, empty array when it cannot be one.

    A JSON array of scalars gives its elements as text (numbers and booleans
    in their JSON spelling, JSON null as NULL). Text that is not JSON, JSON
    that is not an array, or an array holding any object or array gives the
    empty array: a strict array-of-text cast that fails as a whole, wrapped
    in TRY and defaulted.
    """
    v = F.try_parse_json(_c(text))
    elems = F.try_variant_get(v, "$", "array<variant>")
    nested = F.exists(elems, lambda e: F.schema_of_variant(e).rlike("^(OBJECT|ARRAY)"))
    as_text = F.transform(elems, lambda e: F.try_variant_get(e, "$", "string"))
    empty = F.array().cast(ArrayType(StringType()))
    return F.when(elems.isNull() | nested, empty).otherwise(as_text)


def explode_tags(df: DataFrame, array_col: str, out: str = "tag", keep_empty: bool = False) -> DataFrame:
    """One row per element; rows with an empty or NULL array are dropped, or kept with NULL."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out, explode(F.col(array_col))).drop(array_col)


# Fields of one per-question element of a result array.
RESULT_FIELDS = ("questionId", "score", "scored", "idleTime", "isAnswered", "isAnswerCorrect")

RESULT_SCHEMA = ArrayType(StructType([StructField(f, StringType(), True) for f in RESULT_FIELDS]))


def parse_results(text: ColumnOrName, mode: str = "PERMISSIVE") -> Column:
    """Result JSON text -> ``array<struct<...:string>>``.

    ``mode="FAILFAST"`` makes malformed text fail the job (the source's
    behaviour); the default nulls it.
    """
    return F.from_json(_c(text), RESULT_SCHEMA, {"mode": mode})


def result_fields(q: ColumnOrName) -> list[Column]:
    """U4: typed scalar fields of one element; bad values become NULL."""
    e = _c(q)
    return [
        e["questionId"].alias("question_id"),
        e["score"].try_cast("double").alias("max_score"),
        e["scored"].try_cast("double").alias("achieved_score"),
        e["idleTime"].try_cast("double").alias("idle_time_sec"),
        e["isAnswered"].try_cast("boolean").alias("is_answered"),
        e["isAnswerCorrect"].try_cast("boolean").alias("is_answer_correct"),
    ]


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable",
            value: str = "value") -> DataFrame:
    """Melt / unpivot ``values`` into (variable, value) rows."""
    return df.unpivot(list(ids), list(values), variable, value)


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None,
             fill: int = 0) -> DataFrame:
    """Count table of ``row`` x ``col``, zero-filled.

    ``values`` fixes the output columns (no extra job to discover them);
    the counts are one grouped aggregate.
    """
    g = df.groupBy(row)
    g = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    out = g.count()
    return out.fillna(fill, subset=[c for c in out.columns if c != row])
