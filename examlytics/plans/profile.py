"""Candidate-versus-peer profiles (P1-P14), for every candidate at once.

The source built one profile per click in pandas over a fetched frame. Here
:func:`candidate_profiles` computes every part for all e-mails in one set
of jobs; :func:`candidate_profile` is a lookup (a filter on the e-mail,
which Catalyst pushes below the windows keyed by e-mail).

Peer statistics over the whole population (rank, percentile, median of
integrity, the peer histogram) use the range-partitioned ranking instead of
a single-task window or collect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.operators.windows import exact_median, pct_rank_avg, rank_over, sequence_over

# Profile constants.
PEER_BINS = 25
HEADLINE_SEP = " · "


def _hist_key() -> Column:
    return F.struct(F.col("pseq"), F.coalesce(F.col("start_time").cast("string"), F.lit("~")),
                    F.coalesce("test_id", F.lit("")), F.coalesce("assessment_taker_id", F.lit("")))


def history(peer: DataFrame, numbered: bool = False, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The peer rows with ``pseq``, the sitting number per (e-mail, test) in this frame.

    ``numbered``: no slicer was applied since ``seq`` was made, so it is the
    same number; only rows without one (no test id) are numbered here, and
    only they go through ``keep`` (the others are read from ``peer``).
    """
    if numbered:
        known = peer.where(F.col("email").isNotNull() & F.col("seq").isNotNull()).withColumn("pseq", F.col("seq"))
        return known.unionByName(keep(history(peer.where(F.col("email").isNotNull() & F.col("seq").isNull())).select(*known.columns)))
    return sequence_over(peer.where(F.col("email").isNotNull()), ["email", "test_id"],
                         ["start_time", "assessment_taker_id", "attempt_number"], out="pseq")


def peer_standing(peer: DataFrame, parts: int | None = None) -> DataFrame:
    """Per e-mail mean score, the peer average of means, rank (min) and percentile (0-100)."""
    means = peer.where(F.col("score_pct").isNotNull() & F.col("email").isNotNull()).groupBy("email").agg(
        F.avg("score_pct").alias("cand_avg"))
    return _standing(means, parts)


def _standing(means: DataFrame, parts: int | None) -> DataFrame:
    r = rank_over(means, "cand_avg", descending=True, parts=parts)
    peer_avg = means.agg(F.avg("cand_avg")).scalar()  # uncorrelated scalar subquery, evaluated once
    return r.select(
        "email", "cand_avg", peer_avg.alias("peer_avg"), F.col("rank_min").alias("rank"),
        F.col("n").alias("total_peers"),
        (pct_rank_avg(F.col("rank_min"), F.col("ties"), F.col("n")) * 100).alias("percentile"))


def _integrity() -> Column:
    total = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(0.0))), F.lit(0.0))
    return total("violation_count") * 2.0 + total("violation_duration_sec") / 60.0


def integrity(peer: DataFrame, parts: int | None = None) -> DataFrame:
    """Per e-mail integrity score and the exact peer median of it."""
    per = peer.where(F.col("email").isNotNull()).groupBy("email").agg(_integrity().alias("integrity"))
    med = exact_median(per, "integrity", parts).scalar()
    return per.select("*", med.alias("peer_integrity_med"))


def per_test(hist: DataFrame) -> DataFrame:
    """One row per (e-mail, test): sittings, first and latest score, and the span of its start times.

    The gaps between consecutive sittings of a test add up to that span, so
    their mean needs no ordering of the sittings.
    """
    k = _hist_key()
    at = F.unix_micros(F.col("start_time").cast("timestamp"))
    return hist.groupBy("email", "test_id").agg(
        F.count(F.lit(1)).alias("sittings"), F.min_by("score_pct", k).alias("first"), F.max_by("score_pct", k).alias("latest"),
        (F.max(at) - F.min(at)).alias("span_us"), (F.count("start_time") - 1).alias("gaps"))


def by_specialization(hist: DataFrame, peer: DataFrame) -> DataFrame:
    """P5: per (e-mail, specialization) attempts, average, pass rate, and the peer average."""
    cand = hist.where(F.col("specialization").isNotNull()).groupBy("email", "specialization").agg(
        F.count(F.lit(1)).alias("attempts"), F.avg("score_pct").alias("avg"),
        (F.avg(F.col("is_pass").cast("double")) * 100).alias("pass_rate"))
    peer_spec = peer.where(F.col("specialization").isNotNull()).groupBy("specialization").agg(
        F.avg("score_pct").alias("peer_avg"))
    return cand.join(peer_spec, "specialization", "left")


def by_difficulty(hist: DataFrame) -> DataFrame:
    """Per (e-mail, test difficulty) attempts, average and pass rate."""
    return hist.where(F.col("test_difficulty").isNotNull()).groupBy("email", "test_difficulty").agg(
        F.count(F.lit(1)).alias("attempts"), F.avg("score_pct").alias("avg"),
        (F.avg(F.col("is_pass").cast("double")) * 100).alias("pass_rate"))


def retake_effectiveness(hist: DataFrame) -> DataFrame:
    """Per re-sat (e-mail, test): sittings, first and latest score (by sitting order), lift."""
    k = _hist_key()
    g = hist.where(F.col("test_id").isNotNull()).groupBy("email", "test_id").agg(
        F.min_by("test_title", k).alias("test"), F.count(F.lit(1)).alias("sittings"),
        F.min_by("score_pct", k).alias("first"), F.max_by("score_pct", k).alias("latest"))
    return g.where(F.col("sittings") > 1).withColumn("lift", F.col("latest") - F.col("first"))


def flagged_sittings(hist: DataFrame) -> DataFrame:
    """Sittings with violations (sort by violation_count descending to display)."""
    return hist.where(F.coalesce(F.col("violation_count"), F.lit(0.0)) > 0).select(
        "email", "test_title", "start_time", "violation_count", "violation_duration_sec", "score_pct", "pass_status")


def peer_distribution(standing: DataFrame, bins: int = PEER_BINS) -> DataFrame:
    """Histogram of the peer means in ``bins`` equal-width bins between their min and max."""
    rng = standing.select(standing.agg(F.min("cand_avg")).scalar().alias("lo"),
                          standing.agg(F.max("cand_avg")).scalar().alias("hi"), "cand_avg")
    b = rng.select(
        F.when(F.col("hi") > F.col("lo"),
               F.least(F.floor((F.col("cand_avg") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)),
                       F.lit(bins - 1))).otherwise(F.lit(0)).cast("int").alias("bin"), "lo", "hi")
    return b.groupBy("bin", "lo", "hi").agg(F.count(F.lit(1)).alias("candidates")).select(
        "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"), "candidates")


def timeline(hist: DataFrame) -> DataFrame:
    """Score over time per e-mail, split by specialization when the person has more than one."""
    n_spec = hist.groupBy("email").agg(F.count_distinct("specialization").alias("__n_spec"))
    return hist.join(n_spec, "email", "left").select(
        "email", "start_time", "score_pct", "specialization", "test_title",
        (F.col("__n_spec") > 1).alias("split_by_specialization"))


def summary(peer: DataFrame, parts: int | None = None, hist: DataFrame | None = None) -> DataFrame:
    """P2-P4, P8, P10, P11, P14 in one row per e-mail (``hist``: a precomputed :func:`history`)."""
    hist = hist if hist is not None else history(peer)
    k = _hist_key()
    vc = F.coalesce(F.col("violation_count"), F.lit(0.0))
    base = hist.groupBy("email").agg(
        F.min_by("candidatename", F.when(fx.nonblank(F.col("candidatename")), F.struct(
            F.coalesce(F.col("start_time").cast("string"), F.lit("~")), F.coalesce("test_id", F.lit("")),
            F.coalesce("assessment_taker_id", F.lit(""))))).alias("first_name"),
        F.count(F.lit(1)).alias("n_attempts"), F.avg("score_pct").alias("cand_avg"),
        F.max("score_pct").alias("cand_max"), F.min("score_pct").alias("cand_min"),
        F.avg("duration_min").alias("avg_time"),
        (F.avg((F.col("pass_status") == "passed").cast("double")) * 100).alias("pass_rate"),
        F.sum(vc).alias("viol_total"), F.count_if(vc > 0).alias("n_flagged"),
        _integrity().alias("integrity"),
        F.max("start_time").alias("last_active"),
        F.max_by("proficiency_level", F.when(F.col("proficiency_level").isNotNull(), k)).alias("latest_prof"))
    resat = F.col("test_id").isNotNull() & (F.col("sittings") > 1)
    lift = F.col("latest") - F.col("first")
    tests = per_test(hist).groupBy("email").agg(
        F.count("test_id").alias("n_tests"),
        F.count_if(resat & (lift > 0)).alias("retakes_improved"),
        F.count_if(resat & (lift < 0)).alias("retakes_declined"),
        F.count_if(resat & (lift == 0)).alias("retakes_unchanged"),
        F.count_if(resat).alias("retaken_tests"),
        (F.sum(F.when(F.col("gaps") > 0, F.col("span_us")))
         / F.nullif(F.sum(F.when(F.col("gaps") > 0, F.col("gaps"))), F.lit(0)) / F.lit(86400e6)).alias("avg_retake"))
    spec = hist.where(F.col("specialization").isNotNull()).groupBy("email", "specialization").agg(F.avg("score_pct").alias("avg"))
    best = spec.groupBy("email").agg(
        F.min_by("specialization", F.when(F.col("avg").isNotNull(),
                                          F.struct(-F.col("avg"), F.col("specialization"))))
        .alias("strongest_specialization"))  # highest average; ties: alphabetical
    means = base.select("email", "cand_avg").where(F.col("cand_avg").isNotNull())
    standing = _standing(means, parts).drop("cand_avg")
    out = (base.join(tests, "email", "left").join(best, "email", "left").join(standing, "email", "left")
           .withColumn("peer_integrity_med", exact_median(base.select("integrity"), "integrity", parts).scalar()))
    up, down = F.coalesce("retakes_improved", F.lit(0)), F.coalesce("retakes_declined", F.lit(0))
    head = F.concat_ws(
        HEADLINE_SEP,
        F.when(F.col("cand_avg").isNotNull() & F.col("peer_avg").isNotNull(),
               F.when(F.col("cand_avg") >= F.col("peer_avg"), F.lit("above peer avg")).otherwise(F.lit("below peer avg"))),
        F.when(F.col("strongest_specialization").isNotNull(),
               F.concat(F.lit("strongest in "), F.col("strongest_specialization"))),
        F.when(F.col("retaken_tests") > 0,
               F.when(up > down, F.lit("retakes help")).when(down > up, F.lit("retakes don't help"))
               .otherwise(F.lit("retakes mixed"))),
        F.when(F.col("n_flagged") > 0, F.concat(F.col("n_flagged").cast("string"), F.lit(" flagged sitting(s)"))))
    return out.select(
        "email", F.coalesce(F.nullif(F.trim("first_name"), F.lit("")), F.col("email")).alias("name"),
        "n_attempts", "n_tests", "cand_avg", "cand_max", "cand_min", "peer_avg", "rank", "total_peers",
        "percentile", "avg_time", "pass_rate", "viol_total", "n_flagged", "integrity", "peer_integrity_med",
        "avg_retake", "latest_prof", "last_active", "strongest_specialization",
        F.coalesce("retakes_improved", F.lit(0)).alias("retakes_improved"),
        F.coalesce("retakes_declined", F.lit(0)).alias("retakes_declined"),
        F.coalesce("retakes_unchanged", F.lit(0)).alias("retakes_unchanged"),
        head.alias("headline"))


def candidate_profiles(peer: DataFrame, parts: int | None = None,
                       hist: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every profile part for every e-mail, keyed by part name."""
    hist = hist if hist is not None else history(peer)
    standing = peer_standing(peer, parts)
    return {
        "summary": summary(peer, parts, hist),
        "history": hist,
        "specialization": by_specialization(hist, peer),
        "difficulty": by_difficulty(hist),
        "retakes": retake_effectiveness(hist),
        "flagged": flagged_sittings(hist),
        "peer_distribution": peer_distribution(standing),
        "timeline": timeline(hist),
    }


def candidate_profile(peer: DataFrame, email: str, parts: int | None = None) -> dict[str, DataFrame]:
    """One candidate's profile parts (peer statistics still over the whole peer frame)."""
    parts_ = candidate_profiles(peer, parts)
    return {k: (v if k == "peer_distribution" else v.where(F.col("email") == email)) for k, v in parts_.items()}
