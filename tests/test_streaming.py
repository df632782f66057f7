import pytest

from numprep import ColumnSpec, fit
from numprep.streaming import scale_new_files


@pytest.mark.parametrize("inverse", [False, True])
def test_new_files_are_scaled_once(spark, tmp_path, inverse):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    first = spark.createDataFrame([("$0", 1), ("$10", 2)], "c string, k int")
    model = fit(first, [ColumnSpec("c", prefix="$", rounding=1)])
    rows = model.transform(first) if inverse else first
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(source)
        scale_new_files(spark, model, source, rows.schema, target, checkpoint, inverse).awaitTermination()
    scale_new_files(spark, model, source, rows.schema, target, checkpoint, inverse).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(target).collect()))
    assert got == sorted(([("$0.0", 1), ("$10.0", 2)] if inverse else [(0.0, 1), (1.0, 2)]) * 2)
