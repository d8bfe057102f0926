"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerline.llm.encode import op4_bpe
from ledgerline.llm.exact import OP6_SQL, op6_exact_dedup
from ledgerline.llm.extract import op10_html
from ledgerline.llm.fingerprint import op5_fingerprints
from ledgerline.llm.near import op7_minhash
from ledgerline.llm.packing import op9_packing
from ledgerline.llm.passages import op2_substring_dedup
from ledgerline.llm.periodic import op11_periodic
from ledgerline.llm.personal import OP12_SQL, op12_pii
from ledgerline.llm.quality import op1_quality
from ledgerline.llm.toxicity import op8_toxicity
from ledgerline.llm.vectors import OP13_SQL, op13_codes
from ledgerline.llm.warc import OP3_SQL, op3_warc

_ROOT = str(Path(corpus_pipeline.__file__).resolve().parent)


def _findable(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Python workers import this package too, from whatever folder the driver was started in."""

    @wraps(job)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
        return job(spark, sf_dir)

    return query


_JOBS = {
    "op1_quality": op1_quality,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_fingerprints": op5_fingerprints,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_minhash": op7_minhash,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_html": op10_html,
    "op11_periodic": op11_periodic,
    "op12_pii": op12_pii,
    "op13_codes": op13_codes,
    "pipeline": corpus_pipeline.run,
}
QUERIES = {name: _findable(job) for name, job in _JOBS.items()}

ORACLES = {
    "op3_warc": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op12_pii": OP12_SQL, "op13_codes": OP13_SQL,
}
