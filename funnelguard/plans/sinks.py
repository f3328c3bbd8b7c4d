"""K2 / K3: publishing alerts.

Instead of one HTTP call per alert from the driver, alerts become JSON
payload rows and are written as a table partition keyed by the run's
``as_of``: re-running the same ``as_of`` (after a failure, or a lost
executor) replaces that partition, so publishing is idempotent. A
downstream notifier reads the partition.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timewin import to_utc_naive
from ..schemas import NOT_APPLICABLE

PAYLOAD_TEXTS = ("alert_name", "vertical_name", "campaign_name", "campaign_id", "calculated_value_timeframe",
                 "benchmark_timeframe", "landing_page")
PAYLOAD_NUMBERS = ("calculated_value", "benchmark", "spend", "leads", "base_threshold")
PAYLOAD_FIELDS = (", ".join(f"{n} STRING" for n in PAYLOAD_TEXTS + PAYLOAD_NUMBERS)
                  + ", calculated_value_is_infinite BOOLEAN")


def alert_payloads(alerts: DataFrame, as_of: datetime | str) -> DataFrame:
    """K2: (as_of, alert_key, payload) with one JSON document per alert.

    Fields that do not apply are rendered as "N/A"; a number that is not
    finite (minutes since a conversion that never happened) is rendered as
    null, with ``calculated_value_is_infinite`` set for the value itself,
    since JSON has no infinity. The key is a JSON array, so no separator in
    an id can make two keys alike.
    """
    stamp = run_stamp(as_of)
    na = F.lit(NOT_APPLICABLE)

    def number(name: str) -> Column:
        return F.when(_finite(name), F.col(name))

    def number_or_na(name: str) -> Column:
        # a JSON value of either kind: parsed, so that it is rendered as it is
        return F.parse_json(F.when(F.col(name).isNull(), F.to_json(F.array(na)).substr(2, len(NOT_APPLICABLE) + 2))
                            .otherwise(F.coalesce(number(name).cast("string"), F.lit("null"))))

    body = alerts.select(
        "alert_name", "vertical_name",
        F.coalesce("campaign_name", na).alias("campaign_name"),
        F.coalesce("campaign_id", na).alias("campaign_id"),
        number("calculated_value").alias("calculated_value"),
        (F.col("calculated_value").isNotNull() & ~_finite("calculated_value")).alias("calculated_value_is_infinite"),
        "calculated_value_timeframe", number("benchmark").alias("benchmark"), "benchmark_timeframe",
        F.coalesce("landing_page", na).alias("landing_page"),
        number_or_na("spend").alias("spend"), number_or_na("leads").alias("leads"),
        number("base_threshold").alias("base_threshold"))
    payload = F.to_json(F.struct(*body.columns), {"ignoreNullFields": "false"})
    key = F.to_json(F.array(F.lit(stamp), "alert_name", "vertical_name", "campaign_id", "landing_page"))
    return body.select(F.lit(stamp).alias("as_of"), key.alias("alert_key"), payload.alias("payload"))


def _finite(name: str) -> Column:
    value = F.col(name).cast("double")
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def payload_fields(payloads: DataFrame) -> DataFrame:
    """The fields of K2's documents read back, numbers as DOUBLE (NULL where "N/A" or null stands)."""
    read = F.from_json("payload", PAYLOAD_FIELDS)
    texts = [F.col(f"doc.{n}").alias(n) for n in PAYLOAD_TEXTS]
    numbers = [F.expr(f"try_cast(doc.{n} AS double)").alias(n) for n in PAYLOAD_NUMBERS]
    applies = [(F.col(f"doc.{n}") != NOT_APPLICABLE).alias(f"{n}_applies") for n in ("spend", "leads")]
    return payloads.select("as_of", "alert_key", read.alias("doc")).select(
        "as_of", "alert_key", *texts, *numbers, *applies,
        F.col("doc.calculated_value_is_infinite").alias("calculated_value_is_infinite"))


def run_stamp(as_of: datetime | str) -> str:
    """A run's instant to the microsecond, in characters that a path may hold."""
    return to_utc_naive(as_of).strftime("%Y-%m-%dT%H-%M-%S.%f")


def write_alerts(alerts: DataFrame, path: str, as_of: datetime | str, fmt: str = "parquet") -> None:
    """Write the alerts of one run to ``<path>/as_of=<instant>``, replacing what an earlier run of it left there.

    A run without alerts leaves an empty partition, so no alert outlives it.
    """
    alerts.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/as_of={run_stamp(as_of)}")


PUBLISHED = "as_of string, alert_key string, payload string"


def published(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`publish` has written so far: (as_of, alert_key, payload)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], PUBLISHED)
    return spark.read.schema(PUBLISHED + ", batch string").parquet(path).drop("batch")


def publish(alerts: DataFrame, path: str, as_of: datetime | str) -> DataFrame:
    """Append the payloads whose key was not published before, each key once, as one batch; returns the batch.

    A notifier sends a batch's rows. Running an evaluation again, or another one that overlaps it, publishes only keys
    that are new; a run that fails leaves no batch, as Spark commits a write's files at its end, of each task one attempt.
    There is one publisher of a path at a time.
    """
    spark = alerts.sparkSession
    fresh = (alert_payloads(alerts, as_of).dropDuplicates(["alert_key"])
             .join(published(spark, path).select("alert_key"), "alert_key", "left_anti").select("as_of", "alert_key", "payload"))
    batch = f"{path.rstrip('/')}/batch={run_stamp(as_of)}-{uuid.uuid4().hex[:8]}"
    fresh.write.parquet(batch)
    return spark.read.schema(PUBLISHED).parquet(batch)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """K3: number of fired alerts per (alert_name, vertical_name)."""
    return alerts.groupBy("alert_name", "vertical_name").agg(F.count(F.lit(1)).alias("alert_count"))
