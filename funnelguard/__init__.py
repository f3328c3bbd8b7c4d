"""funnelguard: performance-anomaly alerts over advertising funnel facts, as Spark plans.

Public entry points::

    from funnelguard import load_facts, config_frame, evaluate, Params
    facts = load_facts(spark, "analytics_db")          # or a parquet directory
    alerts = evaluate(facts, config_frame(spark, doc), as_of="2024-01-30T15:00:00Z")
    write_alerts(alerts, "s3://bucket/alerts", as_of)  # one action
"""

from .params import Params
from .operators import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa, lp_abandonment,
                        performance_decline, volume_drop)
from .operators.scope import Scope, scope_facts, thresholds_for
from .plans.engine import evaluate, evaluation
from .plans.sinks import alert_payloads, alert_summary, write_alerts
from .sources.config import config_frame, explode_config
from .sources.facts import Facts, facts_from_frames, load_facts

__all__ = [
    "Params", "evaluate", "evaluation", "Scope", "scope_facts", "thresholds_for", "alert_payloads", "alert_summary", "write_alerts",
    "config_frame", "explode_config", "Facts", "facts_from_frames", "load_facts",
    # checks: <check>.controlled(scope, thresholds) and <check>.automated(scope)
    "volume_drop", "flow_interruption", "high_cpa", "performance_decline", "fb_to_clickout", "clickout_to_conversion",
    "lp_abandonment",
]
