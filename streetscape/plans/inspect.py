"""Plan inspection helpers (used by tests and scripts/explain_plans.py)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def formatted_plan(df: DataFrame) -> str:
    """The executed physical plan in ``explain("formatted")`` layout (AQE's final plan when the
    query has run)."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges_carrying(df: DataFrame, column: str) -> int:
    """Number of shuffle exchanges (not broadcasts) whose input includes ``column``."""
    text = formatted_plan(df)
    count = 0
    for m in re.finditer(r"^\(\d+\) (\w+)[^\n]*\n(?:[^\n]*\n)*?Input \[\d+\]: \[([^\]]*)\]", text, re.M):
        node, inputs = m.group(1), m.group(2)
        if node in ("Exchange", "ShuffleQueryStage") and re.search(rf"\b{re.escape(column)}#", inputs):
            count += 1
    return count
