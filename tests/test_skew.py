"""Hot keys: one site and one event hold a third of all rows."""

from pyspark.sql import functions as F

from conftest import SMALL
from tallyhall.operators import joins, rollups
from tallyhall.sources import fixtures as fx

N = 30_000


def hot_fact(spark):
    i = F.col("id")
    hot = (i % 3) == 0
    return spark.range(N).select(
        F.when(hot, F.lit(0)).otherwise(F.floor(i / 4)).cast("bigint").alias("event_id"),
        F.concat(F.lit("p"), (i % 7001).cast("string")).alias("participant_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (i % 50).cast("string"))).alias("event_site_refid"),
        F.when(i % 2 == 0, "Perempuan").otherwise("Lelaki").alias("gender"),
        (i % 40).cast("string").alias("age"),
        F.when(i % 5 == 0, "true").otherwise("false").alias("oku_status"),
    )


def test_hot_site_rollup_matches_brute_force(spark):
    f = hot_fact(spark)
    sites = f.select(F.col("event_site_refid").alias("refid")).distinct() \
             .withColumn("site_name", F.col("refid")).withColumn("state", F.lit("X"))
    got = {r.refid: r for r in rollups.site_index(f, sites).collect()}
    pdf = f.toPandas()
    hot = pdf[pdf.event_site_refid == "HOT"]
    assert len(hot) == N // 3
    g = got["HOT"]
    assert g.events == hot.event_id.nunique() and g.pax_total == hot.participant_id.nunique()
    assert g.women == int((hot.gender == "Perempuan").sum())
    age = hot.age.astype(float)
    assert g.youth == int(age.between(15, 24).sum()) and g.children == int((age < 12).sum())


def test_hot_event_join_with_skew_splitting(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                          "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                          "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        f = hot_fact(spark)
        ev = spark.range(N // 4 + 1).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("pillar"))
        j = f.join(ev, "event_id", "inner")
        per = {r.pillar: r.n for r in j.groupBy("pillar").agg(F.count(F.lit(1)).alias("n")).collect()}
        pdf = f.toPandas()
        want = (pdf.event_id % 5).value_counts().to_dict()
        assert per == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_key_dedupe(spark):
    f = hot_fact(spark)
    d = joins.dedupe_first(f, ["event_site_refid"], ["event_id", "participant_id"])
    got = {r.event_site_refid: (r.event_id, r.participant_id) for r in d.collect()}
    pdf = f.toPandas().sort_values(["event_id", "participant_id", "gender", "age", "oku_status"])
    want = pdf.groupby("event_site_refid").first()
    assert got["HOT"] == (want.loc["HOT"].event_id, want.loc["HOT"].participant_id)
    assert len(got) == len(want)


def test_event_join_exchanges_are_planner_owned(spark):
    """Skew-join splitting applies only to planner-inserted exchanges; the
    fact builder must not pin the event join with a user repartition."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = fx.fact(spark, SMALL, ["event_id", "participant_id", "pillar_name"])
        plan = f._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    lines = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(event_id" in ln]
    assert lines and all("ENSURE_REQUIREMENTS" in ln for ln in lines)


def test_hot_event_is_split_under_an_aggregate_on_its_key(spark):
    """The aggregate would reuse the join's partitioning; the skewed join is
    split all the same."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = spark.range(N // 4 + 1).select(F.col("id").alias("event_id"), F.lit("2026-01-05").cast("date").alias("event_startdate"),
                                            F.lit(1).cast("bigint").alias("requester_id"))
        f = hot_fact(spark).withColumn("attendance", F.lit(True)).join(ev, "event_id", "inner")
        out = rollups.week_event_drilldown(f)
        rows = {(r.refid, r.event_id): (r.p, r.a) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows["HOT", 0] == (len({i % 7001 for i in range(0, N, 3)}), N // 3)
    assert "skew=true" in plan
