"""Shared base views for a session.

Most views read the per-attempt base (V1) or its cohort extension (V14).
:class:`Analytics` writes each base once per silver bundle as a Parquet table
in the cluster's shared folder (``spark.checkpoint.dir``) and reads it back, so
a dashboard-style run of many views scans and deduplicates the silver tables
once, every view reads only the columns it needs, and a lost executor
re-reads files. :meth:`release` deletes the tables.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from examlytics.operators.joins import SizedDimensions, as_planned
from examlytics.plans import cohort, cube, org, seeds
from examlytics.session import discard, keep, shared_dir
from examlytics.sources.lake import write_lookup
from examlytics.sources.silver import Silver


class Analytics:
    """``algo`` is the bucket hash of the forced mapping: the source's XXH64, or ``md5`` for engines without it.

    ``persist=False`` keeps the bases as plans: nothing is written or run
    before a view is queried.
    """

    def __init__(self, spark: SparkSession, silver: Silver, persist: bool = True,
                 internal_pattern: str | None = None, sf_dir: str | None = None, algo: str = "xxh64",
                 internal_domains: tuple[str, ...] = seeds.INTERNAL_DOMAINS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.silver = silver
        self.persist = persist
        self.internal_pattern = internal_pattern
        self.internal_domains = internal_domains
        self.algo = algo
        self._kept: list[DataFrame] = []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.persist:
            return df
        out = keep(df, name)
        self._kept.append(out)
        return out

    @cached_property
    def cp(self) -> DataFrame:
        """V1 candidate performance (persisted)."""
        kw = {"internal_pattern": self.internal_pattern} if self.internal_pattern else {}
        return self._keep(org.candidate_performance(self.silver, dimension=self.dimension, **kw), "candidate-performance")

    @property
    def dimension(self):
        """How bases join deduplicated dimensions: kept, and broadcast if their stored size allows."""
        return SizedDimensions(self._keep) if self.persist else as_planned

    def ca(self, algo: str | None = None, force_map: bool = True) -> DataFrame:
        """V14 cohort attempt for a bucket hash (default: the context's) and mapping mode (persisted)."""
        algo = algo or self.algo
        key = (algo, force_map)
        cache = self.__dict__.setdefault("_ca", {})
        if key not in cache:
            crosswalk = seeds.specialization_crosswalk(self.spark, internal_domains=self.internal_domains)
            cache[key] = self._keep(cohort.cohort_attempt(self.spark, self.cp, self.silver, algo=algo,
                                                          force_map=force_map, crosswalk=crosswalk, dimension=self.dimension), "cohort-attempt")
        return cache[key]

    def candidates(self, by: str, force_map: bool = True) -> DataFrame:
        """Measures per person and ``cohort`` or ``specialization`` (read several times by their rankings; persisted)."""
        cache = self.__dict__.setdefault("_candidates", {})
        if (by, force_map) not in cache:
            make = {"cohort": cohort.cohort_candidates, "specialization": cohort.specialization_candidates}[by]
            cache[by, force_map] = self._keep(make(self.ca(force_map=force_map)), f"{by}-candidates")
        return cache[by, force_map]

    @cached_property
    def base(self) -> DataFrame:
        """M1 training working set (V14, with ``seq``; persisted, read by ~40 marts)."""
        from examlytics.plans.marts import prepare_base
        return self._keep(prepare_base(self.ca()), "training-base")

    @cached_property
    def history(self) -> DataFrame:
        """P1 profile history (training base with per-frame sitting numbers; persisted)."""
        from examlytics.plans.profile import history
        return self._keep(history(self.base, numbered=True), "profile-history")

    @cached_property
    def history_rows(self) -> DataFrame:
        """The same rows read from the training base; only those numbered for the history are written."""
        from examlytics.plans.profile import history
        return history(self.base, numbered=True, keep=lambda df: self._keep(df, "profile-history-numbered"))

    @cached_property
    def retake(self) -> DataFrame:
        """V4 retake intervals (read by the retake view, KPI strip and histogram; persisted)."""
        return self._keep(org.retake_intervals(self.cp), "retake-intervals")

    @cached_property
    def qp(self) -> DataFrame:
        """V23 question performance (read by the view and the question rankings; persisted)."""
        return self._keep(cohort.question_performance(self.spark, self.silver), "question-performance")

    @cached_property
    def lookups(self) -> DataFrame:
        """V1 laid out for lookups by e-mail and by (taker, test, attempt) (persisted)."""
        if not self.persist:
            return self.cp
        out = write_lookup(self.cp, f"{shared_dir(self.spark)}/lookups-{uuid.uuid4().hex}", ["email"], ["assessment_taker_id", "test_id"])
        self._kept.append(out)
        return out

    @cached_property
    def executive_cube(self) -> cube.Cube:
        """Measures and member sets by month, difficulty and organization (persisted)."""
        return cube.executive_cube(self.cp, self._keep)

    @cached_property
    def cohort_cube(self) -> cube.Cube:
        """Measures, member sets and score sketches by cohort, specialization and month (persisted)."""
        return cube.cohort_cube(self.ca(), self._keep)

    @cached_property
    def responses(self) -> DataFrame:
        """One row per served question of each latest valid attempt (persisted)."""
        return self._keep(cohort.question_responses(self.silver), "question-responses")

    def release(self) -> None:
        """Delete the written bases; the next view that needs one builds it again."""
        for df in self._kept:
            discard(df)
        self._kept.clear()
        for k in ("cp", "_ca", "_candidates", "base", "history", "history_rows", "retake", "qp", "responses", "executive_cube", "cohort_cube", "lookups"):
            self.__dict__.pop(k, None)
