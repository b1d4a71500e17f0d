"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it wrote,
and returns the documents it keeps; the last returns the packed pieces. The texts
pass through Python models and tokenizers, so SQL can't express the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanclean.llm.base import documents, stage
from loanclean.llm.packing import pack_stage
from loanclean.llm.pii import redact_stage
from loanclean.llm.quality import keep_good
from loanclean.llm.simhash import drop_near_duplicates
from loanclean.llm.tiling import drop_contaminated

STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_stage),
    ("packing", pack_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
