"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm.common import materialize, table
from panelwright.llm.jaccard import keep_first
from panelwright.llm.language import keep_known
from panelwright.llm.packing import pack_stage
from panelwright.llm.pii import mask
from panelwright.llm.quality import keep_good

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known),
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", keep_first),
    ("pii", mask),
    ("best_fit_packing", pack_stage),
]

#: The models of language, quality and personal data are trained on the rows at hand, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
