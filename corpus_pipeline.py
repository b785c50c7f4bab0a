"""Training-data pipeline over ``documents``: quality rules, toxicity, SimHash near-dedup, mixing, packing.

Each stage works on all that the one before it kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innsight.llm import queries as q
from innsight.llm.common import stored

#: (name, function) of each stage; a function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = (
    ("quality_rules", q.stage_quality),
    ("toxicity", q.stage_toxicity),
    ("simhash_dedup", q.stage_simhash_dedup),
    ("mixing", q.stage_mixing),
    ("packing", q.stage_packing),
)

#: None: SimHash, the string kernel, the splitting tree and packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the filtered, deduplicated and mixed documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
