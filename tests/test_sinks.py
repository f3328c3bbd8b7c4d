"""Alert payloads, the idempotent table sink and the summary."""

from __future__ import annotations

import json
import math
import uuid

import pytest
from pyspark.sql import functions as F

from funnelguard.plans.sinks import alert_payloads, alert_summary, payload_fields, publish, published, write_alerts
from funnelguard.schemas import ALERT
from funnelguard.session import ensure_checkpoint_dir

ROWS = [
    ("flowInterruption", "v", None, None, math.inf, "Minutes since last Click-out/Lead", 30.0,
     "Controlled Threshold (minutes)", None, 12.5, None, 30.0),
    ("highCPA", "v", "Camp", "c1", 60.0, "Last 6 Hours", 55.0, "Controlled Threshold", None, 60.0, 1, 50.0),
]


def test_payload_renders_not_applicable_and_infinity(spark):
    alerts = spark.createDataFrame(ROWS, ALERT)
    docs = {json.loads(r.alert_key)[1]: json.loads(r.payload)
            for r in alert_payloads(alerts, "2024-01-30 15:00:00").collect()}
    flow = docs["flowInterruption"]
    assert flow["calculated_value"] is None and flow["calculated_value_is_infinite"] is True
    assert flow["campaign_id"] == "N/A" and flow["leads"] == "N/A" and flow["spend"] == 12.5
    cpa = docs["highCPA"]
    assert cpa["campaign_id"] == "c1" and cpa["leads"] == 1 and cpa["landing_page"] == "N/A"


def test_write_is_idempotent_per_as_of(spark):
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/sink-test-{uuid.uuid4().hex}"
    alerts = spark.createDataFrame(ROWS, ALERT)
    write_alerts(alerts, path, "2024-01-30 15:00:00")
    write_alerts(alerts, path, "2024-01-30 15:00:00")
    write_alerts(alerts.limit(1), path, "2024-01-30 16:00:00")
    counts = {r.as_of: r["count"] for r in spark.read.parquet(path).groupBy("as_of").count().collect()}
    assert counts == {"2024-01-30T15-00-00.000000": 2, "2024-01-30T16-00-00.000000": 1}


def test_summary_counts(spark):
    alerts = spark.createDataFrame(ROWS + ROWS[1:], ALERT)
    got = {(r.alert_name, r.alert_count) for r in alert_summary(alerts).collect()}
    assert got == {("flowInterruption", 1), ("highCPA", 2)}


def test_a_run_without_alerts_leaves_none_behind(spark):
    path = f"{ensure_checkpoint_dir(spark)}/sink-test-{uuid.uuid4().hex}"
    alerts = spark.createDataFrame(ROWS, ALERT)
    write_alerts(alerts, path, "2024-01-30 15:00:00.2")
    write_alerts(alerts, path, "2024-01-30 15:00:00.7")
    assert spark.read.parquet(path).count() == 4
    write_alerts(alerts.limit(0), path, "2024-01-30 15:00:00.2")
    assert [r.as_of for r in spark.read.parquet(path).select("as_of").distinct().collect()] == ["2024-01-30T15-00-00.700000"]


def test_keys_and_infinite_numbers(spark):
    rows = [("a", "v|x", None, "y", 1.0, "t", math.inf, "t", None, None, None, math.inf),
            ("a", "v", None, "x|y", 1.0, "t", 2.0, "t", None, 0.0, 3, 1.0)]
    found = alert_payloads(spark.createDataFrame(rows, ALERT), "2024-01-30").collect()
    assert len({r.alert_key for r in found}) == 2
    docs = [json.loads(r.payload) for r in found]
    assert docs[0]["benchmark"] is None and docs[0]["base_threshold"] is None and docs[0]["spend"] == "N/A"
    assert docs[1]["spend"] == 0.0 and docs[1]["leads"] == 3 and docs[1]["calculated_value_is_infinite"] is False
    fields = payload_fields(alert_payloads(spark.createDataFrame(rows, ALERT), "2024-01-30")).collect()
    assert [r.spend_applies for r in fields] == [False, True] and fields[1].leads == 3.0


def test_each_key_is_published_once(spark):
    path = f"{ensure_checkpoint_dir(spark)}/published-{uuid.uuid4().hex}"
    alerts = spark.createDataFrame(ROWS, ALERT)
    assert published(spark, path).count() == 0
    assert publish(alerts.limit(1), path, "2024-01-30 15:00:00").count() == 1
    assert publish(alerts.unionByName(alerts), path, "2024-01-30 15:00:00").count() == 1  # the other one, once
    assert publish(alerts, path, "2024-01-30 15:00:00").count() == 0
    assert publish(alerts, path, "2024-01-30 16:00:00").count() == 2
    rows = published(spark, path).collect()
    assert len(rows) == 4 == len({r.alert_key for r in rows})


def test_a_failed_publication_leaves_nothing_and_can_be_repeated(spark):
    path = f"{ensure_checkpoint_dir(spark)}/published-{uuid.uuid4().hex}"
    alerts = spark.createDataFrame(ROWS, ALERT).repartition(2)
    # one row fails while its task runs, after others may have been written
    broken = alerts.withColumn("campaign_name", F.when(F.col("alert_name") == "highCPA", F.raise_error(F.lit("killed"))).otherwise(F.col("campaign_name")))
    with pytest.raises(Exception, match="killed"):
        publish(broken, path, "2024-01-30 15:00:00")
    assert published(spark, path).count() == 0
    assert publish(alerts, path, "2024-01-30 15:00:00").count() == 2 == published(spark, path).count()
