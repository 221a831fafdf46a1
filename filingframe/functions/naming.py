"""Column-name conversion. Runs on names only, never on rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# The word-boundary patterns that define the snake_case contract.
_BOUNDARIES = (
    (r"(.)([A-Z][a-z]+)", r"\1_\2"),
    (r"__([A-Z])", r"_\1"),
    (r"([a-z0-9])([A-Z])", r"\1_\2"),
)


def snake_case(name: str) -> str:
    """``PublishDateTime`` -> ``publish_date_time``; a run of capitals stays one word."""
    for pattern, spaced in _BOUNDARIES:
        name = re.sub(pattern, spaced, name)
    return name.lower()


def camel_case(name: str) -> str:
    """``publish_date_time`` -> ``publishDateTime``."""
    return re.sub(r"_([^_]*)", lambda word: word[1].title(), name)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))


def camel_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(camel_case, df.columns))
