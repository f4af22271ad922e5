"""Daily sums: the same answers as the facts, refreshed by day."""

from pyspark.sql import functions as F

from supplylens.plans import metric_views as V
from supplylens.sources.buckets import BucketStore
from supplylens.sources.domain import SupplyTables
from supplylens.sources.sums import TABLES, DailySums


class Changed(SupplyTables):
    """Facts in which one day lost its rows and another one has other regions."""

    lost, moved = None, None

    def shipments(self, *args, **kw):
        rows = super().shipments(*args, **kw).where(F.col("ship_date") != F.lit(self.lost))
        region = F.when(F.col("ship_date") == F.lit(self.moved), "ASIA").otherwise(F.col("destination_region"))
        return rows.withColumn("destination_region", region)


def content(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_a_refresh_replaces_the_days_it_is_given(spark, small):
    t = SupplyTables(spark, small)
    sums = DailySums.build(BucketStore.new(spark, "sums"), t, 32)
    days = [r[0] for r in sums.shipped().select("ship_date").distinct().orderBy("ship_date").limit(40).collect()]
    Changed.lost, Changed.moved = days[5], days[30]
    after = Changed(spark, small)
    before = sums.store.manifest()
    sums.refresh(after, [days[5], days[30]])
    now = sums.store.manifest()
    assert now.version == before.version + 1
    for name in TABLES:
        old, new = before.tables[name]["folders"], now.tables[name]["folders"]
        assert sum(old.get(b) != new.get(b) for b in set(old) | set(new)) <= 2
    rebuilt = DailySums.build(BucketStore.new(spark, "sums"), after, 32)
    assert content(sums.shipped()) == content(rebuilt.shipped()) and content(sums.sold()) == content(rebuilt.sold())
    assert sums.shipped().where(F.col("ship_date") == F.lit(days[5])).isEmpty()


def test_answers_read_no_lines(spark, small):
    t = SupplyTables(spark, small)
    sums = DailySums.build(BucketStore.new(spark, "sums"), t)
    stored = V.delivery_from_sums(sums.shipped(), t.anchor)
    direct = V.delivery_performance(t.shipments(), t.anchor)
    for dims in (["region"], []):
        assert content(stored.query(dims)) == content(direct.query(dims))
    plan = stored.query(["region"])._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan
