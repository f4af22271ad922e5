"""The newest month with data, when orders arrive before their lines."""

from pyspark.sql import functions as F

from supplylens.registry import queries
from supplylens.session import new_folder

NAMES = ["supplier_risk_scorecard", "top_risk_suppliers"]


def test_newest_orders_without_lines_change_nothing(spark, small):
    root = new_folder(spark, "late")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        rows = spark.read.parquet(f"{small}/{name}.parquet")
        if name == "orders":
            later = rows.limit(3).withColumns({"o_orderkey": F.col("o_orderkey") + 10**9, "o_orderdate": F.add_months("o_orderdate", 60).cast(rows.schema["o_orderdate"].dataType)})
            rows = rows.unionByName(later)
        rows.write.parquet(f"{root}/{name}.parquet")
    for name in NAMES:
        got, want = (sorted(map(tuple, queries()[name](spark, at).collect()), key=repr) for at in (root, small))
        assert got == want and got, name
