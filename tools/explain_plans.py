"""Print the physical plans of the stages of one evaluation, with a one-line summary each.

Usage: python tools/explain_plans.py [sf_dir] [--full]
The summary counts scans, pushed filters, shuffles, broadcasts, sort-merge
joins and windows; ``--full`` also prints ``explain("formatted")``.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from funnelguard.operators import metrics, rollups  # noqa: E402
from funnelguard.operators.lp_abandonment import LOADER_STEP  # noqa: E402
from funnelguard.plans.catalog import Fixture  # noqa: E402
from funnelguard.session import local_session  # noqa: E402


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    counts = {
        "scans": plan.count("FileScan parquet"),
        "shuffles": plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning"),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python_udfs": plan.count("EvalPython"),
    }
    first = next((p for p in pushed if p), "")
    return " ".join(f"{k}={v}" for k, v in counts.items()) + (f" | pushed: {first[:140]}" if first else "")


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(app="funnelguard-explain")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # do not truncate PushedFilters
    fx = Fixture(spark, sf_dir)
    sc = fx.scope
    stages = {
        "hourly rollup": rollups.hourly_rollup(fx.facts, sc.clock, sc.params),
        "session rollups": rollups.session_rollups(fx.facts, sc.clock, list(rollups.session_windows(sc.clock))),
        "conversions per second": rollups.conversion_seconds(fx.facts, sc.clock, sc.pairs),
        "funnel rollup": rollups.funnel_rollup(fx.facts, sc.clock, LOADER_STEP),
    }
    sc.prepare()
    stages.update({
        "campaign metrics (from rollups)": metrics.campaign_metrics(sc, metrics.TABLES["campaign_metrics"]),
        "vertical metrics (from rollups)": metrics.vertical_metrics(sc, metrics.TABLES["vertical_metrics"]),
        "page metrics (from rollups)": metrics.page_metrics(sc, metrics.TABLES["page_metrics"]),
        "alerts (from metric tables)": fx.alerts(),
    })
    for name, df in stages.items():
        print(f"{name:34s} {summary(df)}")
        if full:
            df.explain("formatted")


if __name__ == "__main__":
    main()
