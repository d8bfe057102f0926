"""Name, job and reference SQL of every query."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import use_utc

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Job], Job]:
    """Register a job under ``name`` together with the SQL it is compared with."""

    def register(job: Job) -> Job:
        @wraps(job)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(use_utc(spark), sf_dir)

        QUERIES[name] = run
        ORACLES[name] = oracle
        return run

    return register
