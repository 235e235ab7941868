import pyarrow as pa
from pyspark.sql import functions as F

from metroloom.plans.scratch import dealt, materialise


def test_rows_of_a_key_stay_together_above_a_join_on_it(spark):
    """The planner may drop an exchange that repeats a join's, and read the join's locally."""
    a = materialise(spark.range(2000).select((F.col("id") % 40).alias("k"), "id"), "a").repartition(8)
    b = materialise(spark.range(40).select(F.col("id").alias("k")), "b").groupBy("k").count().filter("count > 0").select("k")

    def spans(batches):
        keys = [k for batch in batches for k in batch.column(0).to_pylist()]
        assert keys == sorted(keys)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(set(keys)), pa.int64())], ["k"])

    joined = a.join(b, "k", "left_semi").select("k", "id")
    seen = [r["k"] for r in dealt(joined, "k", order=("id",)).mapInArrow(spans, "k bigint").collect()]
    assert sorted(seen) == list(range(40))
