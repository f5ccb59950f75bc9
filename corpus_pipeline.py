"""From raw documents to token digests: language ID, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is stored as Parquet in the
shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import encode_documents
from tidemark.llm.common import kept, table
from tidemark.llm.language import keep_identified
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.mixing import repeat_to_targets
from tidemark.llm.simhash import keep_one_of_each_group

STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each_group),
    ("source_mix", repeat_to_targets),
    ("bpe_encode", encode_documents),
]

#: Learned scores and random rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
