"""The corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark leaks, token ids. Each stage is written as Parquet and read again as
the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gazetta.llm import byte_bpe, decontaminate, minhash_dedup, quality_rules, substring_dedup
from gazetta.llm.util import clear_scratch, read_table, scratch_path, written

#: Folders that the stage before wrote for itself, by application.
_BEFORE: dict[str, list[str]] = {}


def _alone(stage):
    """``stage``, which first deletes what the stage before wrote for itself
    (its result has been written and reread as ``docs``; if it was not, and
    ``docs`` still reads those folders, they stay)."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId
        old = _BEFORE.pop(key, [])
        if old and not any(path.rsplit("/", 1)[1] in f for f in docs.inputFiles() for path in old):
            clear_scratch(spark, old)
        have = set(written(spark))
        out = stage(spark, docs, sf_dir)
        _BEFORE[key] = [p for p in written(spark) if p not in have]
        return out

    return run_stage


#: (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("quality_rules", _alone(quality_rules.stage)),
    ("minhash_dedup", _alone(minhash_dedup.stage)),
    ("substring_dedup", _alone(substring_dedup.stage)),
    ("decontaminate", _alone(decontaminate.stage)),
    ("byte_bpe", _alone(byte_bpe.stage)),
]

#: Not expressible in SQL: the stages from near-duplicate detection on are
#: tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
