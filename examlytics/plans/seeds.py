"""Seed relations (V10-V13): editable mapping tables.

Each seed is a small, fixed-size DataFrame built from a Python literal; its
size is bounded by the literal, so joins against it are explicit broadcasts.
Callers may pass their own rows to override the defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from examlytics.functions.scalar import key_norm

# ---------------------------------------------------------------------------
# Default seed rows (domain crosswalk, category crosswalk,
# program keywords, program durations) and the force-map label lists.
# ---------------------------------------------------------------------------
SPECIALIZATION_CROSSWALK = [
    ("Backend Engineering", "Backend", False),
    ("Frontend Engineering", "Frontend", False),
    ("Programming - JavaScript", "Frontend", False),
    ("Programming", "Software Development", False),
    ("Programming Language Part One", "Software Development", False),
    ("Coding Trials", "Software Development", False),
    ("Software Development", "Software Development", False),
    ("Data Engineering", "Data Engineering", False),
    ("Cloud Engineering", "Cloud", False),
    ("AWS", "Cloud", False),
    ("DevOps Engineering", "DevOps", False),
    ("Mobile Engineering", "Mobile", False),
    ("Software Testing", "Software Testing", False),
    ("Product and Project Management", "Product & Project Mgmt", False),
    ("Business Development", "Business Development", False),
    ("Accounting", "Finance & Accounting", False),
    ("Social Studies", "General Education", False),
    ("IT Skills", "IT Skills", False),
    ("Aptitude", "Aptitude", True),
    ("Aptitude Test Candidate's Ability", "Aptitude", True),
]

# Neutral default: domains used for the organization's own tests. They are
# excluded from specializations; callers pass the names of their deployment.
INTERNAL_DOMAINS = ("Internal Pool",)
INTERNAL_LABEL = "Internal/Test"

CATEGORY_CROSSWALK = [
    ("Node", "Node.js", "Backend"),
    ("Node.js", "Node.js", "Backend"),
    ("Python", "Python", "Backend"),
    ("Java", "Java", "Backend"),
    ("Distributed Systems", "Distributed Systems", "Backend"),
    ("JavaScript", "JavaScript", "Frontend"),
    ("Typescript", "TypeScript", "Frontend"),
    ("Angular", "Angular", "Frontend"),
    ("React", "React", "Frontend"),
    ("Fabric", "Microsoft Fabric", "Data Engineering"),
    ("AWS", "AWS", "Data Engineering"),
    ("Cypress", "Cypress", "Software Testing"),
    ("Manual Testing", "Manual Testing", "Software Testing"),
    ("Automation", "Test Automation", "Software Testing"),
    ("Practical", "Practical", "Software Development"),
]

COHORT_TAG_VOCABULARY = [
    ("national service", "NSP"),
    ("nsp", "NSP"),
    ("apprentice", "Apprenticeship"),
    ("graduate", "Graduate Trainee"),
    ("cdc", "CDC"),
    ("it skill", "Upskilling"),
    ("upskill", "Upskilling"),
]

PROGRAM_REFERENCE = [
    ("NSP", 12),
    ("Apprenticeship", 6),
    ("Graduate Trainee", None),
    ("CDC", None),
    ("Upskilling", None),
]

FORCE_MAP_SPECIALIZATIONS = ["Backend", "Frontend", "Data Engineering", "Cloud", "DevOps",
                             "Software Testing", "Software Development", "Mobile"]
FORCE_MAP_PROGRAMS = ["NSP", "Graduate Trainee", "Apprenticeship", "Upskilling", "CDC"]

_S = StringType()


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


def specialization_crosswalk(spark: SparkSession, rows: Sequence[tuple] = SPECIALIZATION_CROSSWALK,
                             internal_domains: Sequence[str] = INTERNAL_DOMAINS) -> DataFrame:
    """Normalised domain key -> specialization, exclusion flag (internal domains are excluded)."""
    rows = [*rows, *((d, INTERNAL_LABEL, True) for d in internal_domains)]
    return spark.createDataFrame(rows, _schema(("key_norm", _S), ("specialization", _S),
                                                     ("is_excluded", BooleanType())))


def category_crosswalk(spark: SparkSession, rows: Sequence[tuple] = CATEGORY_CROSSWALK) -> DataFrame:
    """Normalised category key -> tech and parent specialization."""
    return spark.createDataFrame(list(rows), _schema(("key_norm", _S), ("tech", _S), ("specialization", _S)))


def cohort_tag_vocabulary(spark: SparkSession, rows: Sequence[tuple] = COHORT_TAG_VOCABULARY) -> DataFrame:
    """Program keyword (matched as a lower-case substring) -> program."""
    return spark.createDataFrame(list(rows), _schema(("keyword", _S), ("program", _S)))


def program_reference(spark: SparkSession, rows: Sequence[tuple] = PROGRAM_REFERENCE) -> DataFrame:
    """Program -> duration in months (nullable)."""
    return spark.createDataFrame(list(rows), _schema(("program", _S), ("duration_months", IntegerType())))


def with_join_key(seed: DataFrame) -> DataFrame:
    """Seed with its lower-cased ``key_norm`` precomputed as ``__k`` (equi-join key)."""
    return seed.withColumn("__k", F.lower(F.col("key_norm")))


def norm_join(df: DataFrame, name_col: str, seed: DataFrame, prefix: str) -> DataFrame:
    """Left join a crosswalk on ``lower(trim(strip_suffix(name))) = lower(key_norm)``.

    The computed key is materialised on the big side so the join is a plain
    equi-join; the seed is a literal of known size, so it is broadcast.
    """
    s = with_join_key(seed)
    s = s.select(F.col("__k").alias(f"{prefix}__k"),
                 *[F.col(c).alias(f"{prefix}_{c}") for c in seed.columns if c != "key_norm"])
    keyed = df.withColumn(f"{prefix}__dk", key_norm(F.col(name_col)))
    return (keyed.join(F.broadcast(s), F.col(f"{prefix}__dk") == F.col(f"{prefix}__k"), "left")
            .drop(f"{prefix}__dk", f"{prefix}__k"))
