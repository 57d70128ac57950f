"""Union of tables by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, duplicates included; absent columns are NULL.

    Columns of one name must have one type; Spark alone would widen them.
    """
    types = dict(first.dtypes)
    for other in others:
        for name, dtype in other.dtypes:
            if types.setdefault(name, dtype) != dtype:
                raise TypeError(f"column {name!r} is {types[name]} here and {dtype} there")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)
