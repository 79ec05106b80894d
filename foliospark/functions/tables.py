"""Table functions over Arrow batches: plug-ins that turn a table argument into another table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def line_splitter(schema: StructType, text: str = "text"):
    """A table function for tables of this schema: one row per line of ``text``, other columns repeated.

    Register it and call ``SELECT * FROM name(TABLE(...))``, with ``PARTITION BY`` where a partition has to
    stay together. Its result type follows from the argument's. A null text has no lines.
    """
    kept = [field for field in schema if field.name != text]

    @arrow_udtf(returnType=StructType([*kept, StructField("line_no", IntegerType()), StructField("line", StringType())]))
    class SplitLines:
        def eval(self, rows: pa.RecordBatch):
            lines = pc.split_pattern(rows.column(text), "\n")
            owner, sizes = pc.list_parent_indices(lines), pc.fill_null(pc.list_value_length(lines), 0).to_numpy()
            number = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = {field.name: rows.column(field.name).take(owner) for field in kept}
            yield pa.table({**columns, "line_no": pa.array(number.astype(np.int32)), "line": pc.list_flatten(lines)})

    return SplitLines
