"""Scale newly arrived files with stored parameters.

Scaling is a projection without state, so ``FittedModel.transform`` and ``inverse_transform`` take a streaming
table as they are. Fitting needs the whole table and stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from numprep.plans.model import FittedModel


def scale_new_files(
    spark: SparkSession,
    model: FittedModel,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    inverse: bool = False,
) -> StreamingQuery:
    """Transform (or restore) all Parquet files not handled before, append them to ``target``, and stop.

    ``checkpoint`` records which files are done. It has to be the same folder from run to run, on storage the
    whole cluster reaches.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    scaled = model.inverse_transform(rows) if inverse else model.transform(rows)
    return (
        scaled.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
