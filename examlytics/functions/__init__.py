"""Scalar Column expressions (native Catalyst, no Python UDFs)."""

from examlytics.functions.scalar import *  # noqa: F401,F403
from examlytics.functions.scalar import (  # noqa: F401
    bool_text, candidate_name, candidate_source, diff_days, diff_hours, diff_seconds,
    div_dec1, email_domain, hash_bucket, integrity_label, integrity_risk,
    iso_to_timestamp, key_norm, local_part, md5_60, month_text, nonblank,
    normalise_pass, pct, pct_dec1, proficiency_level, quarter_label,
    question_label, retake_direction, safe_div, sql_candidate_name, title_case,
    trim_ws, violation_severity, xxh64, year_text,
)
