"""HTML question text to plain text (FN14, FN15).

Tags and whitespace are handled by native regular expressions. Character
references are decoded in Python (``html.unescape``, the full entity table) by
an Arrow-batched pandas UDF; Spark sends every row through it, so callers cut
their rows first (the question rankings label their few rows last).
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else x)


def strip_html(x: Column | str) -> Column:
    """``<br>`` and closing p/div/li become spaces, other tags vanish, entities
    are decoded, non-breaking spaces become spaces, whitespace runs collapse,
    ends are trimmed. NULL or empty input gives ''."""
    c = F.col(x) if isinstance(x, str) else x
    # The tags that separate words.
    breaks = r"(?i)<br\s*/?>|</(?:p|div|li)>"
    s = F.regexp_replace(F.regexp_replace(c, breaks, " "), r"<[^>]+>", "")
    s = _unescape(s)
    s = F.replace(s, F.lit(" "), F.lit(" "))
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), r"(?U)^\s+|\s+$", "")
    return F.coalesce(s, F.lit(""))


def with_question_label(qp: DataFrame, text: str = "question_text", title: str = "question_title",
                        out: str = "question", empty: str = "(no text)") -> DataFrame:
    """FN15: label = cleaned text, else cleaned title, else ``empty``."""
    t = strip_html(text)
    ti = strip_html(title)
    label = F.when(F.length(t) > 0, t).when(F.length(ti) > 0, ti).otherwise(F.lit(empty))
    return qp.withColumn(out, label)


def clean_text(df: DataFrame, cols: list[str], suffix: str = "_text") -> DataFrame:
    """Table job: add a cleaned plain-text column for each HTML column."""
    return df.select("*", *[strip_html(c).alias(c + suffix) for c in cols])
