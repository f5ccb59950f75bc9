"""Row counts taken while the data passes by, without an extra job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that holds ``rows`` once an action has run over it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
