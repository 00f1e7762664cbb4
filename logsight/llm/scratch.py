"""Tables written to the shared scratch folder to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logsight.scratch import materialise


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the folder that spark.checkpoint.dir names, read back."""
    return materialise(df, f"llm-{label}")
