"""Which configured mapping a file belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import paths


def first_match(path: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """Index of the first pattern, in configuration order, that matches the start of the path;
    NULL when none does (F2). Mapping ignores letter case, walking a folder does not (F1).

    The patterns come from a configuration file, so they become one conditional expression:
    no join, no shuffle, and later patterns are not tried once one matched.
    """
    hit = F.lit(None).cast("int")
    for index in reversed(range(len(patterns))):
        hit = F.when(paths.matches(path, patterns[index], ignore_case), F.lit(index)).otherwise(hit)
    return hit


def map_files(files: DataFrame, path: Column, patterns: Sequence[str]) -> DataFrame:
    return files.withColumn("mapping", first_match(path, patterns))
