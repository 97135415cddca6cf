"""Zones beyond the broadcast bound: fact and zones in the same buckets."""

import uuid

from pyspark.sql import functions as F

from tripmart.operators import joins as J


def test_no_exchange_and_no_hot_bucket(spark, tmp_path):
    n, buckets = 30_000, 8
    # one zone holds a third of the trips, one has none, some trips have no zone
    zone = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 500).cast("int")
    fact = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("trip_key"), zone.alias("pu_zone_key"),
                                 (F.col("id") % 11).alias("amount"))
    zones = spark.range(520).select(F.col("id").cast("int").alias("zone_key"), F.concat(F.lit("z"), "id").alias("zone_name"))
    hot = {r.pu_zone_key: r._copies for r in J.hot_keys(fact, "pu_zone_key", buckets).collect()}
    assert hot == {7: 3}
    names = [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    paths = tuple(str(tmp_path / x) for x in names)
    J.save_colocated(fact, zones, "pu_zone_key", "zone_key", "trip_key", buckets, *names, paths=paths)
    try:
        joined = J.colocated_join(spark, *names, "pu_zone_key", "zone_key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = fact.join(zones, F.col("pu_zone_key") == F.col("zone_key"))
        cols = ["trip_key", "pu_zone_key", "amount", "zone_name"]
        assert sorted(map(tuple, joined.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
        sizes = [r[0] for r in spark.table(names[0]).groupBy(F.col("_metadata.file_path")).count().select("count").collect()]
        assert max(sizes) < n / 3 and spark.table(names[1]).count() == 520 + 2
        # grouped by the zone alone, only sums are exchanged
        grouped = joined.groupBy("zone_name").agg(F.sum("amount"))._jdf.queryExecution().executedPlan().toString()
        assert grouped.count("Exchange hashpartitioning") == 1 and "partial_sum" in grouped
    finally:
        for x in names:
            spark.sql(f"DROP TABLE IF EXISTS {x}")
