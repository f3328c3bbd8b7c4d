"""G1: every check for every vertical as one DataFrame over tables that are built first.

The driver loops of a per-campaign implementation (one set of actions per
vertical and campaign) become joins with the active pairs and the mode
table. Evaluation has two halves: the scope materialises the active pairs,
the fact rollups and three metric tables (a fixed number of writes), then
each metric table is read once and every row emits the records of the
check branches its vertical's mode selects and that fire; the three
results are unioned into one DataFrame that runs as one action at the
sink. Neither half grows with the number of verticals or campaigns.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa,
                         lp_abandonment, performance_decline, volume_drop)
from ..operators.scope import Scope, alert_modes
from ..params import Params
from ..schemas import (ALERT, CLICKOUT_TO_CONVERSION, FB_TO_CLICKOUT, FLOW_INTERRUPTION, HIGH_CPA,
                       HIGH_LP_ABANDONMENT, PERFORMANCE_DECLINE, VOLUME_DROP)
from ..sources.config import check_verticals, explode_config
from ..sources.facts import Facts


# Metric table -> the checks evaluated on its rows, with their alert names.
CHECKS_BY_TABLE = {
    "campaign_metrics": ((HIGH_CPA, high_cpa), (PERFORMANCE_DECLINE, performance_decline),
                         (FB_TO_CLICKOUT, fb_to_clickout), (CLICKOUT_TO_CONVERSION, clickout_to_conversion)),
    "vertical_metrics": ((VOLUME_DROP, volume_drop), (FLOW_INTERRUPTION, flow_interruption)),
    "page_metrics": ((HIGH_LP_ABANDONMENT, lp_abandonment),),
}


def evaluate(facts: Facts, config: DataFrame, as_of: datetime | str, params: Params | None = None,
             policy: str = "intended", alerts: tuple[str, ...] | None = None, work_dir: str | None = None) -> DataFrame:
    """All alerts fired at ``as_of`` as rows of the 12-field alert schema.

    ``config`` is the nested config (see ``sources.config``). Each check has
    a fixed-threshold and a learned-benchmark branch; the vertical's mode
    decides which one (if any) can raise an alert for it. ``alerts`` limits
    the checks; what only other checks read is not built.

    The rollups and metric tables are built before this returns, in a run
    folder below ``work_dir`` or ``spark.checkpoint.dir``, which goes when
    the application ends; :func:`evaluation` deletes it earlier.
    """
    scope, modes = _open(facts, config, as_of, params, policy, work_dir)
    return evaluate_scope(scope, modes, alerts)


@contextmanager
def evaluation(facts: Facts, config: DataFrame, as_of: datetime | str, params: Params | None = None,
               policy: str = "intended", alerts: tuple[str, ...] | None = None, work_dir: str | None = None):
    """:func:`evaluate` for a ``with`` block: the run's folder is deleted at its end, also after an error."""
    scope, modes = _open(facts, config, as_of, params, policy, work_dir)
    try:
        yield evaluate_scope(scope, modes, alerts)
    finally:
        scope.close()


def _open(facts, config, as_of, params, policy, work_dir) -> tuple[Scope, DataFrame]:
    check_verticals(config)
    modes = alert_modes(explode_config(config), policy)
    return Scope.build(facts, as_of, params, config.select("vertical_name"), work_dir), modes


def evaluate_scope(scope: Scope, modes: DataFrame, alerts: tuple[str, ...] | None = None) -> DataFrame:
    """Fired alerts of every check, one pass over each metric table.

    The modes are pivoted to one row per vertical (mode, base and effective
    threshold of each alert) and joined to each metric table once; every row
    then yields the records of the branches that its vertical's mode selects
    and that fire, exploded into alert rows. Only the names of the alerts
    that some vertical enables (at most seven) are fetched to the driver.
    """
    every = tuple(a for checks in CHECKS_BY_TABLE.values() for a, _ in checks)
    unknown = sorted(set(alerts or ()) - set(every))
    if unknown:
        raise ValueError(f"no such alerts: {', '.join(unknown)}")
    enabled = {r.alert_name for r in modes.select("alert_name").distinct().collect()}
    wanted = tuple(a for a in every if a in enabled and (alerts is None or a in alerts))
    if not wanted:
        return modes.sparkSession.createDataFrame([], ALERT)
    scope.prepare(wanted)
    p = scope.params
    per_vertical = modes.groupBy("vertical_name").agg(*[
        F.max(F.when(F.col("alert_name") == a, F.col(c))).alias(f"{a}__{c}")
        for a in wanted for c in ("mode", "base_threshold", "effective_threshold")])
    out = None
    for table, checks in CHECKS_BY_TABLE.items():
        candidates = []
        for alert_name, check in checks:
            if alert_name not in wanted:
                continue
            mode = F.col(f"{alert_name}__mode")
            base, eff = F.col(f"{alert_name}__base_threshold"), F.col(f"{alert_name}__effective_threshold")
            for branch_mode, branch in check.branches(p).items():
                fires, rec = branch(base, eff)
                candidates.append(F.when((mode == branch_mode) & fires, rec))
        if not candidates:
            continue
        rows = scope.rows(table, wanted).join(per_vertical, "vertical_name", "inner")
        fired_records = F.filter(F.array(*candidates), lambda r: r.isNotNull())
        part = rows.select(F.explode(fired_records).alias("alert")).select("alert.*")
        out = part if out is None else out.unionByName(part)
    return out
