"""Whole texts reach a task in bounded Arrow batches, in frames that are written after the operator has returned too."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from supplylens.llm import language_id, substring_dedup

BOUND = "spark.sql.execution.arrow.maxRecordsPerBatch"


def largest_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("before, most", [("10000", 1000), ("0", 1000), ("300", 300)])
@pytest.mark.parametrize("operator", ["language", "passages"])
def test_frames_handed_out_are_planned_with_small_batches(spark, odd_documents, operator, before, most):
    held = spark.conf.get(BOUND)
    spark.conf.set(BOUND, before)
    try:
        if operator == "language":
            language_id.identified(odd_documents, F.lit(True))
        else:
            substring_dedup.removed(odd_documents)
        assert largest_batch(spark) == most
    finally:
        spark.conf.set(BOUND, held)
