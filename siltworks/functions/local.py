"""Small tables that the driver makes for a plan."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a relation of the plan itself: a broadcast of it takes no job."""
    kinds = T._parse_datatype_string(schema)
    made = to_arrow_schema(kinds)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array([r[i] for r in rows], made.field(i).type) for i in range(len(made))], schema=made), kinds)
