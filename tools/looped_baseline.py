"""Measure the looped execution pattern against the set-based evaluation, same data, same checks.

Looped: a driver loop over verticals and, inside, over active campaigns;
the facts are filtered to one campaign (or one vertical's campaign list)
and each check is collected on its own, which is 8 + 4C actions per
vertical. Set-based: ``bench.full_run`` (one plan, constant actions).
Prints one JSON line with seconds and Spark job counts of both.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from bench import full_run  # noqa: E402
from funnelguard.operators import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa,  # noqa: E402
                                   lp_abandonment, performance_decline, volume_drop)
from funnelguard.functions.timewin import Clock  # noqa: E402
from funnelguard.operators.scope import Scope, active_campaigns  # noqa: E402
from funnelguard.params import Params  # noqa: E402
from funnelguard.session import local_session  # noqa: E402
from funnelguard.sources import fixture  # noqa: E402
from funnelguard.sources.facts import Facts  # noqa: E402


def _only(facts: Facts, cond) -> Facts:
    return Facts(*(df.where(cond) for df in (facts.hourly, facts.daily, facts.sessions, facts.funnel)))


def looped(spark, sf_dir: str) -> int:
    """Run every check the looped way; returns the number of collected result rows.

    The facts are cached once, active campaigns are fetched once, and every
    vertical and campaign filters the cached facts by literal ids.
    """
    facts = Facts(*(df.cache() for df in fixture.fixture_facts(spark, sf_dir, store=True).by_name().values()))
    names = {(r.vertical_name, r.campaign_id): r.campaign_name for r in
             active_campaigns(facts, Clock.at(fixture.AS_OF), Params()).collect()}
    rows = 0
    for v in sorted({v for v, _ in names}):
        ids = [c for u, c in names if u == v]
        in_vertical = _only(facts, F.col("campaign_id").isin(ids))
        for cid in ids:
            scope = _Lazy(_only(in_vertical, F.col("campaign_id") == cid), {(v, cid): names[v, cid]})
            rows += len(high_cpa.current_by_campaign(scope).join(high_cpa.benchmark(scope), "campaign_id").collect())
            rows += len(performance_decline.by_campaign(scope).collect())
            rows += len(fb_to_clickout.by_campaign(scope).collect())
            rows += len(clickout_to_conversion.by_campaign(scope).collect())
        scope = _Lazy(in_vertical, {k: n for k, n in names.items() if k[0] == v})
        for part in (volume_drop.conversions_last_hour, volume_drop.spend_today, volume_drop.same_hour_average,
                     flow_interruption.minutes_since_conversion, flow_interruption.gap_median,
                     lp_abandonment.abandonment_24h, lp_abandonment.abandonment_prev_week):
            rows += len(part(scope).collect())
    return rows


class _Lazy(Scope):
    """A scope whose intermediates stay plans over the cached facts, with literal active campaigns."""

    def __init__(self, facts: Facts, names: dict):
        spark = facts.hourly.sparkSession
        super().__init__(facts, Clock.at(fixture.AS_OF), Params(), None)
        self._cache["active"] = spark.createDataFrame([(v, c, n) for (v, c), n in names.items()],
                                                      "vertical_name string, campaign_id string, campaign_name string")

    def _once(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def _warm(self, names, threads=4):
        pass

    @property
    def scoped(self) -> Facts:
        return self.facts  # filtered by literal ids already


def _timed(spark, label, fn):
    sc = spark.sparkContext
    sc.setJobGroup(label, label)
    t = time.perf_counter()
    fn()
    seconds = time.perf_counter() - t
    return round(seconds, 3), len(sc.statusTracker().getJobIdsForGroup(label))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"), app="funnelguard-looped")
    out = spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/looped-alerts"
    full_run(spark, "/root/testdata/sf0.001", out + "-warmup")
    looped_s, looped_jobs = _timed(spark, "looped", lambda: looped(spark, sf_dir))
    set_s, set_jobs = _timed(spark, "set", lambda: full_run(spark, sf_dir, out))
    print(json.dumps({"sf_dir": sf_dir, "looped_sec": looped_s, "looped_jobs": looped_jobs,
                      "set_based_sec": set_s, "set_based_jobs": set_jobs}))


if __name__ == "__main__":
    main()
