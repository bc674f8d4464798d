"""Static catalogues that ship with the code: enumerations, dictionaries and lists as tables."""

from __future__ import annotations

import enum
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def seed(spark: SparkSession, values: type[enum.Enum] | Mapping[object, str] | Sequence[str]) -> DataFrame:
    """(id, code, label) of a fixed catalogue.

    An enumeration: its integer values are ids (else places from 1), its names are codes and labels, underscores as spaces.
    A dictionary: places from 1, keys as codes, values as labels. A list: places from 1, values as codes and labels. A
    code that is given twice is an error.
    """
    if isinstance(values, type) and issubclass(values, enum.Enum):
        if len(values.__members__) > len(values):
            raise ValueError(f"{values.__name__} has members of one value")
        rows = [(m.value if isinstance(m.value, int) else i, m.name, m.name.replace("_", " ").capitalize()) for i, m in enumerate(values, 1)]
    elif isinstance(values, Mapping):
        rows = [(i, str(k), v) for i, (k, v) in enumerate(values.items(), 1)]
    else:
        rows = [(i, v, v) for i, v in enumerate(values, 1)]
    if len({r[1] for r in rows}) < len(rows):
        raise ValueError("a code is given twice")
    return spark.createDataFrame(rows, "id long, code string, label string")
