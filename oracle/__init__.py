"""DuckDB oracle SQL for the named queries (independent re-statements)."""

from oracle.cohort_sql import ORACLE as _COHORT
from oracle.views_sql import ORACLE as _VIEWS

ORACLE: dict[str, str] = {}
ORACLE.update(_VIEWS)
ORACLE.update(_COHORT)
from oracle.marts_sql import ORACLE as _MARTS  # noqa: E402

ORACLE.update(_MARTS)
from oracle.sources_sql import ORACLE as _SOURCES  # noqa: E402

ORACLE.update(_SOURCES)
from oracle.documented_sql import ORACLE as _DOC  # noqa: E402

ORACLE.update(_DOC)
from oracle.profile_sql import ORACLE as _PROFILE  # noqa: E402

ORACLE.update(_PROFILE)
from oracle.gold_sql import ORACLE as _GOLD  # noqa: E402

ORACLE.update(_GOLD)
from oracle.incremental_sql import ORACLE as _INCREMENTAL  # noqa: E402

ORACLE.update(_INCREMENTAL)
