"""Dense row numbering without a global sort.

``row_number()`` over an unpartitioned window moves every row into one task.
Instead, rows are numbered inside each partition and the number of rows in all
earlier partitions is added: a table of one row per partition.

The input is written once, with its partition and place, so that both sides of the
join read the same rows whatever the input is computed from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.session import scratch_folder

_PID, _MID, _BASE, _OFFSET, _N = "_ri_pid", "_ri_mid", "_ri_base", "_ri_offset", "_ri_n"


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """``df`` plus ``name``: 0..count-1, unique and gap-free."""
    spark = df.sparkSession
    tagged = df.withColumns({_PID: F.spark_partition_id(), _MID: F.monotonically_increasing_id()})
    folder = f"{scratch_folder(spark, 'row-index')}/rows"
    tagged.write.parquet(folder)
    rows = spark.read.schema(tagged.schema).parquet(folder)
    sizes = rows.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_BASE))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select(_PID, _BASE, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFFSET))
    return (
        rows.join(offsets, _PID)
        .withColumn(name, F.col(_OFFSET) + F.col(_MID) - F.col(_BASE))
        .drop(_PID, _MID, _BASE, _OFFSET)
    )
