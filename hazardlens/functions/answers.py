"""Column functions on model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.functions.text import strip

FENCE = "`" * 3


def strip_fence(answer: Column) -> Column:
    """Answer without the code fence around it."""
    opened = F.regexp_replace(strip(answer), rf"\A(?:{FENCE}json)?(?:{FENCE})?", "")
    return strip(F.regexp_replace(opened, rf"{FENCE}\z", ""))


def parse_labels(answer: Column) -> Column:
    """Label list of an answer; NULL when the answer is not a list of integers."""
    return F.from_json(strip_fence(answer), "array<int>")
