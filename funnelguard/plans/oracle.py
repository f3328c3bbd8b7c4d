"""DuckDB oracle: the registered queries written as plain SQL over the ``events`` view.

The SQL follows the straightforward formulation of each rule (a separate
filtered aggregate per window, full outer joins, a row-level weighted
median, one ordered lag per vertical), so it is an independent check of
the Spark plans, which use one-pass conditional aggregates, distinct-value
weighted medians and sliced lags. Boundaries are literal timestamps
derived from the fixture's ``as_of``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from ..params import Params
from ..sources import fixture
from ..sources.facts import DAILY, FUNNEL, HOURLY, SESSIONS

P = Params()
NOW = datetime.fromisoformat(fixture.AS_OF)


def _ts(value: datetime) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def _d(value: datetime) -> str:
    return f"DATE '{value.strftime('%Y-%m-%d')}'"


def _constants(now: datetime) -> dict[str, str]:
    """The literals of the SQL for one evaluation instant."""
    today = now.replace(hour=0, minute=0, second=0, microsecond=0)
    return {
        "NOW": _ts(now),
        "NOW_M1H": _ts(now - timedelta(hours=1)),
        "NOW_M6H": _ts(now - timedelta(hours=6)),
        "NOW_M24H": _ts(now - timedelta(hours=24)),
        "NOW_M1D": _ts(now - timedelta(days=1)),
        "NOW_M8D": _ts(now - timedelta(days=8)),
        "NOW_M28D": _ts(now - timedelta(days=28)),
        "TODAY_TS": _ts(today),
        "TODAY": _d(today),
        "TODAY_M1": _d(today - timedelta(days=1)),
        "TODAY_M7": _d(today - timedelta(days=7)),
        "D_NOW_M24H": _d(now - timedelta(hours=24)),
        "D_NOW_M8D": _d(now - timedelta(days=8)),
        "D_NOW_M1D": _d(now - timedelta(days=1)),
        "HOUR": str(now.hour),
        "INF": "CAST('inf' AS DOUBLE)",
        "STAMP": f"'{now.strftime('%Y-%m-%dT%H-%M-%S.%f')}'",
    }


CAMPAIGN_ALERTS = "('highCPA', 'performanceDecline', 'fbToClickout', 'clickoutToConversion')"
VERTICAL_ALERTS = "('volumeDrop', 'flowInterruption', 'highLpAbandonment')"

# Common table expressions, in dependency order; every query gets all of them.
CTES = f"""
{SESSIONS} AS ({fixture.VIEW_SQL[SESSIONS]}),
{HOURLY} AS ({fixture.VIEW_SQL[HOURLY]}),
{DAILY} AS ({fixture.VIEW_SQL[DAILY]}),
{FUNNEL} AS ({fixture.VIEW_SQL[FUNNEL]}),
cfg_raw AS ({fixture.CONFIG_SQL}),
cfg AS (
  SELECT vertical_name, alert_name, base AS base_threshold,
         COALESCE(pct, 0.0) AS percent_increase, COALESCE(auto, FALSE) AS automated
  FROM cfg_raw),
act_spend AS (
  SELECT vertical AS vertical_name, campaign_id, campaign_name,
         CAST(SUM(spend) AS DOUBLE) AS recent_spend
  FROM {HOURLY}
  WHERE "timestamp" >= $NOW_M24H AND "timestamp" < $NOW
  GROUP BY 1, 2, 3
  HAVING SUM(spend) > 0),
act_sessions AS (
  SELECT vertical AS vertical_name, campaign_id, CAST(COUNT(session_id) AS BIGINT) AS recent_sessions
  FROM {SESSIONS}
  WHERE "timestamp" >= $NOW_M24H AND "timestamp" < $NOW
  GROUP BY 1, 2
  HAVING COUNT(session_id) > 0),
act_union AS (
  SELECT vertical_name, campaign_id, NULLIF(campaign_name, '') AS nm, recent_spend FROM act_spend
  UNION ALL
  SELECT vertical_name, campaign_id, NULL, NULL FROM act_sessions),
act AS (
  SELECT vertical_name, campaign_id,
         COALESCE(FIRST(nm ORDER BY recent_spend DESC, nm) FILTER (WHERE nm IS NOT NULL), campaign_id)
           AS campaign_name
  FROM act_union GROUP BY 1, 2),
verticals AS (SELECT vertical_name FROM act UNION SELECT vertical_name FROM cfg_raw),
modes0 AS (
  SELECT vertical_name, alert_name, base_threshold, percent_increase,
         CASE WHEN alert_name IN {CAMPAIGN_ALERTS} THEN 'campaign'
              WHEN alert_name IN {VERTICAL_ALERTS} THEN 'vertical' END AS level,
         CASE WHEN alert_name IN {CAMPAIGN_ALERTS} AND automated THEN 'automated'
              WHEN alert_name IN {CAMPAIGN_ALERTS} AND base_threshold IS NOT NULL THEN 'controlled'
              WHEN alert_name IN {VERTICAL_ALERTS} AND automated AND base_threshold IS NOT NULL THEN 'controlled'
              WHEN alert_name IN {VERTICAL_ALERTS} AND automated THEN 'automated' END AS mode
  FROM cfg),
modes AS (
  SELECT vertical_name, alert_name, level, mode,
         CASE WHEN mode = 'automated' THEN CAST(NULL AS DOUBLE) ELSE base_threshold END AS base_threshold,
         CASE WHEN mode = 'automated' THEN 0.0 ELSE percent_increase END AS percent_increase,
         CASE WHEN mode = 'automated' THEN CAST(NULL AS DOUBLE)
              WHEN percent_increase > 0 THEN base_threshold * (1 + percent_increase / 100)
              ELSE base_threshold END AS effective_threshold
  FROM modes0
  WHERE mode IS NOT NULL),
thr AS (
  SELECT vertical_name, alert_name, base_threshold,
         CASE WHEN percent_increase > 0 THEN base_threshold * (1 + percent_increase / 100)
              ELSE base_threshold END AS effective_threshold
  FROM cfg WHERE base_threshold IS NOT NULL),

-- volumeDrop
vd_cur AS (
  SELECT v.vertical_name, CAST(COALESCE(x.n, 0) AS BIGINT) AS conversions_last_hour
  FROM verticals v LEFT JOIN (
    SELECT a.vertical_name, COUNT(*) AS n
    FROM {SESSIONS} s JOIN act a USING (campaign_id)
    WHERE s.conversion_dt >= $NOW_M1H AND s.conversion_dt < $NOW
    GROUP BY 1) x USING (vertical_name)),
spend_today AS (
  SELECT v.vertical_name, COALESCE(x.sp, 0.0) AS spend_today
  FROM verticals v LEFT JOIN (
    SELECT a.vertical_name, CAST(SUM(h.spend) AS DOUBLE) AS sp
    FROM {HOURLY} h JOIN act a USING (campaign_id)
    WHERE h."timestamp" >= $TODAY_TS AND h."timestamp" < $NOW
    GROUP BY 1) x USING (vertical_name)),
vd_days AS (
  SELECT a.vertical_name, CAST(s.conversion_dt AS DATE) AS d, COUNT(*) AS n
  FROM {SESSIONS} s JOIN act a USING (campaign_id)
  WHERE CAST(s.conversion_dt AS DATE) >= $TODAY_M7 AND CAST(s.conversion_dt AS DATE) < $TODAY
    AND hour(s.conversion_dt) = $HOUR
  GROUP BY 1, 2),
vd_avg AS (
  SELECT v.vertical_name, COALESCE(AVG(x.n), 0.0) AS same_hour_avg,
         CAST(COUNT(x.d) AS BIGINT) AS days_with_conversions
  FROM verticals v LEFT JOIN vd_days x USING (vertical_name)
  GROUP BY 1),
vd_ctrl AS (
  SELECT c.vertical_name, c.conversions_last_hour, sp.spend_today, t.base_threshold, t.effective_threshold,
         COALESCE(c.conversions_last_hour < t.effective_threshold AND sp.spend_today > {P.min_spend_for_cpa_alert},
                  FALSE) AS fired
  FROM vd_cur c JOIN spend_today sp USING (vertical_name)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'volumeDrop') t USING (vertical_name)),
vd_auto AS (
  SELECT c.vertical_name, c.conversions_last_hour, sp.spend_today, a.same_hour_avg, a.days_with_conversions,
         a.same_hour_avg * {P.volume_drop_factor!r} AS benchmark,
         COALESCE(a.same_hour_avg > 0 AND c.conversions_last_hour < a.same_hour_avg * {P.volume_drop_factor!r}
                  AND sp.spend_today > {P.min_spend_for_cpa_alert}, FALSE) AS fired
  FROM vd_cur c JOIN spend_today sp USING (vertical_name) JOIN vd_avg a USING (vertical_name)),

-- flowInterruption
fi_last AS (
  SELECT v.vertical_name, x.last_dt
  FROM verticals v LEFT JOIN (
    SELECT a.vertical_name, MAX(s.conversion_dt) AS last_dt
    FROM {SESSIONS} s JOIN act a USING (campaign_id)
    WHERE s.conversion_dt < $NOW
    GROUP BY 1) x USING (vertical_name)),
fi_min AS (
  SELECT vertical_name,
         COALESCE(CAST(FLOOR((epoch_us($NOW) - epoch_us(last_dt)) / 60000000) AS DOUBLE), $INF)
           AS minutes_since_conversion
  FROM fi_last),
fi_conv AS (
  SELECT a.vertical_name, s.conversion_dt
  FROM {SESSIONS} s JOIN act a USING (campaign_id)
  WHERE s.conversion_dt >= $NOW_M28D AND s.conversion_dt < $TODAY_TS),
fi_gaps AS (
  SELECT vertical_name, gap_minutes FROM (
    SELECT vertical_name,
           (epoch_us(conversion_dt) // 1000000
            - epoch_us(LAG(conversion_dt) OVER (PARTITION BY vertical_name ORDER BY conversion_dt)) // 1000000)
           / 60 AS gap_minutes
    FROM fi_conv) g
  WHERE gap_minutes IS NOT NULL),
fi_med AS (
  SELECT v.vertical_name, x.median_gap_minutes, CAST(COALESCE(x.num_gaps, 0) AS BIGINT) AS num_gaps
  FROM verticals v LEFT JOIN (
    SELECT vertical_name, quantile_disc(gap_minutes, 0.5) AS median_gap_minutes, COUNT(gap_minutes) AS num_gaps
    FROM fi_gaps WHERE gap_minutes <= {P.flow_max_relevant_gap_minutes}
    GROUP BY 1) x USING (vertical_name)),
fi_thr AS (
  SELECT vertical_name, median_gap_minutes, num_gaps,
         GREATEST({float(P.flow_min_dynamic_threshold_minutes)!r},
                  COALESCE(median_gap_minutes, 0.0) * {P.flow_interruption_automated_multiplier!r}) AS dynamic_threshold
  FROM fi_med),
fi_ctrl AS (
  SELECT m.vertical_name, m.minutes_since_conversion, sp.spend_today, t.base_threshold, t.effective_threshold,
         COALESCE(sp.spend_today > {P.min_spend_for_cpa_alert}
                  AND m.minutes_since_conversion > t.effective_threshold, FALSE) AS fired
  FROM fi_min m JOIN spend_today sp USING (vertical_name)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'flowInterruption') t USING (vertical_name)),
fi_auto AS (
  SELECT m.vertical_name, m.minutes_since_conversion, sp.spend_today, f.median_gap_minutes, f.num_gaps,
         f.dynamic_threshold,
         COALESCE(f.num_gaps >= {P.flow_interruption_min_historical_gaps}
                  AND COALESCE(f.median_gap_minutes, 0) > 0
                  AND m.minutes_since_conversion > f.dynamic_threshold
                  AND sp.spend_today > {P.min_spend_for_cpa_alert}, FALSE) AS fired
  FROM fi_min m JOIN spend_today sp USING (vertical_name) JOIN fi_thr f USING (vertical_name)),

-- highCPA
cpa_sp AS (
  SELECT campaign_id, CAST(SUM(spend) AS DOUBLE) AS current_6h_spend
  FROM {HOURLY} WHERE "timestamp" >= $NOW_M6H AND "timestamp" < $NOW GROUP BY 1),
cpa_vo AS (
  SELECT campaign_id, CAST(COUNT(session_id) AS BIGINT) AS current_6h_volume
  FROM {SESSIONS} WHERE conversion_dt >= $NOW_M6H AND conversion_dt < $NOW GROUP BY 1),
cpa_cur AS (
  SELECT COALESCE(sp.campaign_id, vo.campaign_id) AS campaign_id, sp.current_6h_spend, vo.current_6h_volume,
         CASE WHEN vo.current_6h_volume = 0 THEN $INF
              ELSE sp.current_6h_spend / vo.current_6h_volume END AS current_6h_cpa
  FROM cpa_sp sp FULL OUTER JOIN cpa_vo vo ON sp.campaign_id = vo.campaign_id),
cpa_hsp AS (
  SELECT campaign_id, date_trunc('hour', "timestamp" - INTERVAL 6 HOUR) AS ws,
         CAST(SUM(spend) AS DOUBLE) AS window_spend
  FROM {HOURLY}
  WHERE "timestamp" >= $NOW_M28D AND "timestamp" < $NOW AND dayofweek("timestamp") = dayofweek($NOW)
  GROUP BY 1, 2),
cpa_hvo AS (
  SELECT campaign_id, date_trunc('hour', conversion_dt - INTERVAL 6 HOUR) AS ws,
         CAST(COUNT(session_id) AS BIGINT) AS window_volume
  FROM {SESSIONS}
  WHERE conversion_dt >= $NOW_M28D AND conversion_dt < $NOW AND dayofweek(conversion_dt) = dayofweek($NOW)
  GROUP BY 1, 2),
cpa_hist AS (
  SELECT COALESCE(a.campaign_id, b.campaign_id) AS campaign_id, COALESCE(a.ws, b.ws) AS ws,
         a.window_spend, b.window_volume,
         CASE WHEN b.window_volume = 0 THEN $INF ELSE a.window_spend / b.window_volume END AS cpa
  FROM cpa_hsp a FULL OUTER JOIN cpa_hvo b ON a.campaign_id = b.campaign_id AND a.ws = b.ws
  WHERE COALESCE(a.campaign_id, b.campaign_id) IN (SELECT campaign_id FROM act)),
cpa_q AS (
  SELECT campaign_id, quantile_disc(cpa, {P.cpa_trim_low}) AS p10, quantile_disc(cpa, {P.cpa_trim_high}) AS p90
  FROM cpa_hist GROUP BY 1),
cpa_trim AS (
  SELECT h.* FROM cpa_hist h JOIN cpa_q q USING (campaign_id)
  WHERE h.cpa >= q.p10 AND h.cpa <= q.p90 AND q.p10 IS NOT NULL AND q.p90 IS NOT NULL),
cpa_med AS (
  -- the least value at or below which lies half of the weight
  SELECT campaign_id, MIN(cpa) AS weighted_median_cpa
  FROM (SELECT v.campaign_id, v.cpa,
               (SELECT SUM(b.window_volume) FROM cpa_trim b WHERE b.campaign_id = v.campaign_id AND b.cpa <= v.cpa) AS upto,
               (SELECT SUM(b.window_volume) FROM cpa_trim b WHERE b.campaign_id = v.campaign_id) AS total
        FROM cpa_trim v) x
  WHERE 2 * upto >= total GROUP BY 1),
cpa_dev AS (
  SELECT t.campaign_id, ABS(t.cpa - m.weighted_median_cpa) AS dev, t.window_volume
  FROM cpa_trim t JOIN cpa_med m USING (campaign_id)),
cpa_mad AS (
  SELECT campaign_id, MIN(dev) AS weighted_mad_cpa
  FROM (SELECT v.campaign_id, v.dev,
               (SELECT SUM(b.window_volume) FROM cpa_dev b WHERE b.campaign_id = v.campaign_id AND b.dev <= v.dev) AS upto,
               (SELECT SUM(b.window_volume) FROM cpa_dev b WHERE b.campaign_id = v.campaign_id) AS total
        FROM cpa_dev v) x
  WHERE 2 * upto >= total GROUP BY 1),
cpa_thr AS (
  SELECT * FROM (
    SELECT m.campaign_id, m.weighted_median_cpa, d.weighted_mad_cpa,
           m.weighted_median_cpa + d.weighted_mad_cpa * {P.cpa_mad_scaling_factor!r} * {P.cpa_mad_threshold_multiplier!r}
             AS high_cpa_threshold
    FROM cpa_med m JOIN cpa_mad d USING (campaign_id)) x
  WHERE high_cpa_threshold IS NOT NULL AND high_cpa_threshold <> $INF),
cpa_ctrl AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name,
         CASE WHEN c.campaign_id IS NULL THEN $INF ELSE COALESCE(c.current_6h_cpa, 0.0) END AS current_6h_cpa,
         CASE WHEN c.campaign_id IS NULL THEN 0.0 ELSE c.current_6h_spend END AS current_6h_spend,
         CAST(CASE WHEN c.campaign_id IS NULL THEN 0 ELSE COALESCE(c.current_6h_volume, 0) END AS BIGINT)
           AS current_6h_volume,
         t.base_threshold, t.effective_threshold
  FROM act a LEFT JOIN cpa_cur c USING (campaign_id)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'highCPA') t USING (vertical_name)),
cpa_ctrl_f AS (
  SELECT *, COALESCE(current_6h_cpa > effective_threshold AND current_6h_spend > {P.min_spend_for_cpa_alert}, FALSE)
              AS fired
  FROM cpa_ctrl),
cpa_auto AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, c.current_6h_spend, c.current_6h_volume,
         c.current_6h_cpa, t.weighted_median_cpa, t.weighted_mad_cpa, t.high_cpa_threshold,
         COALESCE(c.current_6h_cpa > t.high_cpa_threshold AND t.high_cpa_threshold <> $INF
                  AND c.current_6h_spend > {P.min_spend_for_cpa_alert}, FALSE) AS fired
  FROM act a JOIN cpa_cur c USING (campaign_id) JOIN cpa_thr t USING (campaign_id)),

-- performanceDecline
pd_rev_t AS (
  SELECT campaign_id, CAST(SUM(conversion_payout) AS DOUBLE) AS todays_revenue
  FROM {SESSIONS} WHERE CAST(conversion_dt AS DATE) = $TODAY AND conversion_dt < $NOW GROUP BY 1),
pd_sp_t AS (
  SELECT campaign_id, CAST(SUM(spend) AS DOUBLE) AS todays_spend
  FROM {DAILY} WHERE "date" = $TODAY GROUP BY 1),
pd_t AS (
  SELECT COALESCE(r.campaign_id, s.campaign_id) AS campaign_id, r.todays_revenue, s.todays_spend,
         CASE WHEN s.todays_spend = 0 THEN $INF ELSE r.todays_revenue / s.todays_spend END AS todays_roi
  FROM pd_rev_t r FULL OUTER JOIN pd_sp_t s ON r.campaign_id = s.campaign_id),
pd_rev_w AS (
  SELECT campaign_id, CAST(SUM(conversion_payout) AS DOUBLE) AS last_week_revenue
  FROM {SESSIONS}
  WHERE CAST(conversion_dt AS DATE) >= $TODAY_M7 AND CAST(conversion_dt AS DATE) <= $TODAY_M1 GROUP BY 1),
pd_sp_w AS (
  SELECT campaign_id, CAST(SUM(spend) AS DOUBLE) AS last_week_spend
  FROM {DAILY} WHERE "date" >= $TODAY_M7 AND "date" <= $TODAY_M1 GROUP BY 1),
pd_w AS (
  SELECT COALESCE(r.campaign_id, s.campaign_id) AS campaign_id, r.last_week_revenue, s.last_week_spend,
         CASE WHEN s.last_week_spend = 0 THEN $INF ELSE r.last_week_revenue / s.last_week_spend END
           AS last_week_roi
  FROM pd_rev_w r FULL OUTER JOIN pd_sp_w s ON r.campaign_id = s.campaign_id),
pd_ctrl AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, t0.todays_roi, t0.todays_spend,
         t.base_threshold, t.effective_threshold,
         COALESCE(t0.todays_spend > {P.min_spend_for_roi_alert} AND t0.todays_roi < t.effective_threshold, FALSE)
           AS fired
  FROM act a JOIN pd_t t0 USING (campaign_id)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'performanceDecline') t USING (vertical_name)),
pd_auto AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, t0.todays_roi, t0.todays_spend,
         w.last_week_roi, w.last_week_spend,
         w.last_week_roi * {P.performance_decline_drop_factor!r} AS benchmark,
         COALESCE(t0.todays_spend > {P.min_spend_for_roi_alert} AND w.last_week_spend > {P.min_spend_for_roi_alert}
                  AND w.last_week_roi <> $INF
                  AND t0.todays_roi < w.last_week_roi * {P.performance_decline_drop_factor!r}, FALSE) AS fired
  FROM act a JOIN pd_t t0 USING (campaign_id) JOIN pd_w w USING (campaign_id)),

-- fbToClickout
fb_cl_t AS (
  SELECT campaign_id, CAST(SUM(clicks) AS BIGINT) AS current_fb_clicks
  FROM {HOURLY} WHERE "timestamp" >= $NOW_M24H AND "timestamp" < $NOW GROUP BY 1),
fb_co_t AS (
  SELECT campaign_id, CAST(COUNT(DISTINCT session_id) AS BIGINT) AS current_clickouts
  FROM {SESSIONS} WHERE session_dt >= $NOW_M24H AND session_dt < $NOW AND postback_id IS NOT NULL GROUP BY 1),
fb_t AS (
  SELECT COALESCE(c.campaign_id, o.campaign_id) AS campaign_id, c.current_fb_clicks, o.current_clickouts,
         CASE WHEN c.current_fb_clicks = 0 THEN 0.0 ELSE o.current_clickouts / c.current_fb_clicks END
           AS current_fb_to_clickout_rate
  FROM fb_cl_t c FULL OUTER JOIN fb_co_t o ON c.campaign_id = o.campaign_id),
fb_cl_w AS (
  SELECT campaign_id, CAST(SUM(clicks) AS BIGINT) AS last_week_fb_clicks
  FROM {HOURLY} WHERE "timestamp" >= $NOW_M8D AND "timestamp" < $NOW_M1D GROUP BY 1),
fb_co_w AS (
  SELECT campaign_id, CAST(COUNT(DISTINCT session_id) AS BIGINT) AS last_week_clickouts
  FROM {SESSIONS} WHERE session_dt >= $NOW_M8D AND session_dt < $NOW_M1D AND postback_id IS NOT NULL
  GROUP BY 1),
fb_w AS (
  SELECT COALESCE(c.campaign_id, o.campaign_id) AS campaign_id, c.last_week_fb_clicks, o.last_week_clickouts,
         CASE WHEN c.last_week_fb_clicks = 0 THEN 0.0 ELSE o.last_week_clickouts / c.last_week_fb_clicks END
           AS last_week_fb_to_clickout_rate
  FROM fb_cl_w c FULL OUTER JOIN fb_co_w o ON c.campaign_id = o.campaign_id),
fb_ctrl AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, x.current_fb_to_clickout_rate, x.current_fb_clicks,
         t.base_threshold, t.effective_threshold,
         COALESCE(x.current_fb_to_clickout_rate < t.effective_threshold
                  AND x.current_fb_clicks >= {P.min_clicks_for_fb_to_clickout}, FALSE) AS fired
  FROM act a JOIN fb_t x USING (campaign_id)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'fbToClickout') t USING (vertical_name)),
fb_auto AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, x.current_fb_to_clickout_rate, x.current_fb_clicks,
         w.last_week_fb_to_clickout_rate,
         w.last_week_fb_to_clickout_rate * {P.fb_to_clickout_drop_factor!r} AS benchmark,
         COALESCE(w.last_week_fb_to_clickout_rate > 0
                  AND x.current_fb_to_clickout_rate < w.last_week_fb_to_clickout_rate * {P.fb_to_clickout_drop_factor!r}
                  AND x.current_fb_clicks >= {P.min_clicks_for_fb_to_clickout}, FALSE) AS fired
  FROM act a JOIN fb_t x USING (campaign_id) JOIN fb_w w USING (campaign_id)),

-- clickoutToConversion
cr_cv_t AS (
  SELECT campaign_id, CAST(COUNT(session_id) AS BIGINT) AS todays_conversions
  FROM {SESSIONS}
  WHERE CAST(conversion_dt AS DATE) = $TODAY AND conversion_dt < $NOW AND conversion_payout IS NOT NULL
  GROUP BY 1),
cr_co_t AS (
  SELECT campaign_id, CAST(COUNT(session_id) AS BIGINT) AS todays_clickouts
  FROM {SESSIONS} WHERE CAST(session_dt AS DATE) = $TODAY AND session_dt < $NOW AND postback_id IS NOT NULL
  GROUP BY 1),
cr_t AS (
  SELECT COALESCE(v.campaign_id, o.campaign_id) AS campaign_id, v.todays_conversions, o.todays_clickouts,
         CASE WHEN o.todays_clickouts = 0 THEN 0.0 ELSE v.todays_conversions / o.todays_clickouts END AS todays_cr
  FROM cr_cv_t v FULL OUTER JOIN cr_co_t o ON v.campaign_id = o.campaign_id),
cr_cv_w AS (
  SELECT campaign_id, CAST(COUNT(session_id) AS BIGINT) AS last_week_conversions
  FROM {SESSIONS} WHERE CAST(conversion_dt AS DATE) = $TODAY_M7 AND conversion_payout IS NOT NULL GROUP BY 1),
cr_co_w AS (
  SELECT campaign_id, CAST(COUNT(session_id) AS BIGINT) AS last_week_clickouts
  FROM {SESSIONS} WHERE CAST(session_dt AS DATE) = $TODAY_M7 AND postback_id IS NOT NULL GROUP BY 1),
cr_w AS (
  SELECT COALESCE(v.campaign_id, o.campaign_id) AS campaign_id, v.last_week_conversions, o.last_week_clickouts,
         CASE WHEN o.last_week_clickouts = 0 THEN 0.0 ELSE v.last_week_conversions / o.last_week_clickouts END
           AS last_week_cr
  FROM cr_cv_w v FULL OUTER JOIN cr_co_w o ON v.campaign_id = o.campaign_id),
cr_ctrl AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, x.todays_cr, x.todays_clickouts,
         t.base_threshold, t.effective_threshold,
         COALESCE(x.todays_cr < t.effective_threshold AND x.todays_clickouts >= {P.min_clickouts_for_cr_alert}, FALSE)
           AS fired
  FROM act a JOIN cr_t x USING (campaign_id)
  LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'clickoutToConversion') t USING (vertical_name)),
cr_auto AS (
  SELECT a.vertical_name, a.campaign_id, a.campaign_name, x.todays_cr, x.todays_clickouts, w.last_week_cr,
         w.last_week_cr * {P.clickout_to_conversion_factor!r} AS benchmark,
         COALESCE(w.last_week_cr > 0 AND x.todays_cr < w.last_week_cr * {P.clickout_to_conversion_factor!r}
                  AND x.todays_clickouts >= {P.min_clickouts_for_cr_alert}, FALSE) AS fired
  FROM act a JOIN cr_t x USING (campaign_id) JOIN cr_w w USING (campaign_id)),

-- highLpAbandonment
lp_st_t AS (
  SELECT a.vertical_name, s.page, CAST(COUNT(s.session_id) AS BIGINT) AS total_started
  FROM {SESSIONS} s JOIN act a USING (campaign_id)
  WHERE s.session_dt >= $NOW_M24H AND s.session_dt < $NOW GROUP BY 1, 2),
lp_su_t AS (
  SELECT a.vertical_name, f.page, CAST(SUM(f.users_reached_step) AS BIGINT) AS successful_24h_count
  FROM {FUNNEL} f JOIN act a USING (campaign_id)
  WHERE f.interaction_type = 'loader' AND f."date" >= $D_NOW_M24H AND f."date" <= $TODAY GROUP BY 1, 2),
lp_t AS (
  SELECT vertical_name, page, total_started, successful_24h_count, total_abandoned,
         CASE WHEN total_started = 0 THEN 0.0 ELSE total_abandoned / total_started END AS current_rate
  FROM (SELECT s.vertical_name, s.page, s.total_started,
               CAST(COALESCE(u.successful_24h_count, 0) AS BIGINT) AS successful_24h_count,
               CAST(CASE WHEN s.total_started - COALESCE(u.successful_24h_count, 0) < 0 THEN 0
                         ELSE s.total_started - COALESCE(u.successful_24h_count, 0) END AS BIGINT) AS total_abandoned
        FROM lp_st_t s LEFT JOIN lp_su_t u USING (vertical_name, page)) x),
lp_st_w AS (
  SELECT a.vertical_name, s.page, CAST(COUNT(s.session_id) AS BIGINT) AS last_week_started
  FROM {SESSIONS} s JOIN act a USING (campaign_id)
  WHERE s.session_dt >= $NOW_M8D AND s.session_dt < $NOW_M1D GROUP BY 1, 2),
lp_su_w AS (
  SELECT a.vertical_name, f.page, CAST(SUM(f.users_reached_step) AS BIGINT) AS last_week_successful
  FROM {FUNNEL} f JOIN act a USING (campaign_id)
  WHERE f.interaction_type = 'loader' AND f."date" >= $D_NOW_M8D AND f."date" < $D_NOW_M1D GROUP BY 1, 2),
lp_w AS (
  SELECT vertical_name, page, last_week_started, last_week_successful, last_week_abandoned,
         CASE WHEN last_week_started = 0 THEN 0.0 ELSE last_week_abandoned / last_week_started END AS last_week_rate
  FROM (SELECT s.vertical_name, s.page, s.last_week_started,
               CAST(COALESCE(u.last_week_successful, 0) AS BIGINT) AS last_week_successful,
               CAST(s.last_week_started - COALESCE(u.last_week_successful, 0) AS BIGINT) AS last_week_abandoned
        FROM lp_st_w s LEFT JOIN lp_su_w u USING (vertical_name, page)) x),
lp_ctrl AS (
  SELECT x.*, t.base_threshold, t.effective_threshold,
         COALESCE(x.current_rate > t.effective_threshold
                  AND x.total_started >= {P.min_sessions_for_lp_abandonment}, FALSE) AS fired
  FROM lp_t x LEFT JOIN (SELECT * FROM thr WHERE alert_name = 'highLpAbandonment') t USING (vertical_name)),
lp_auto AS (
  SELECT x.*, w.last_week_rate, w.last_week_rate * {P.lp_abandonment_benchmark_factor!r} AS benchmark,
         COALESCE(x.current_rate > w.last_week_rate * {P.lp_abandonment_benchmark_factor!r}
                  AND x.total_started >= {P.min_sessions_for_lp_abandonment}
                  AND w.last_week_rate > 0, FALSE) AS fired
  FROM lp_t x JOIN lp_w w USING (vertical_name, page)),

-- every fired alert, dispatched by mode
alerts AS (
  SELECT 'volumeDrop' AS alert_name, r.vertical_name, CAST(NULL AS VARCHAR) AS campaign_name,
         CAST(NULL AS VARCHAR) AS campaign_id, CAST(r.conversions_last_hour AS DOUBLE) AS calculated_value,
         'Last 1 Hour' AS calculated_value_timeframe, r.effective_threshold AS benchmark,
         'Controlled Threshold' AS benchmark_timeframe, CAST(NULL AS VARCHAR) AS landing_page,
         r.spend_today AS spend, CAST(NULL AS BIGINT) AS leads, r.base_threshold AS base_threshold
  FROM vd_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'volumeDrop'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'volumeDrop', r.vertical_name, NULL, NULL, CAST(r.conversions_last_hour AS DOUBLE), 'Last 1 Hour',
         r.benchmark, 'Last 7 Days (same hour avg)', NULL, r.spend_today, NULL, NULL
  FROM vd_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'volumeDrop'
                              AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'flowInterruption', r.vertical_name, NULL, NULL, r.minutes_since_conversion,
         'Minutes since last Click-out/Lead', r.effective_threshold, 'Controlled Threshold (minutes)', NULL,
         r.spend_today, NULL, r.base_threshold
  FROM fi_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'flowInterruption'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'flowInterruption', r.vertical_name, NULL, NULL, r.minutes_since_conversion,
         'Minutes since last Click-out/Lead', r.dynamic_threshold, 'Automated Dynamic Threshold (min)', NULL,
         r.spend_today, NULL, NULL
  FROM fi_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'flowInterruption'
                              AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'highCPA', r.vertical_name, r.campaign_name, r.campaign_id, r.current_6h_cpa, 'Last 6 Hours',
         r.effective_threshold, 'Controlled Threshold', NULL, r.current_6h_spend, r.current_6h_volume,
         r.base_threshold
  FROM cpa_ctrl_f r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'highCPA'
                                 AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'highCPA', r.vertical_name, r.campaign_name, r.campaign_id, r.current_6h_cpa, 'Last 6 Hours',
         r.high_cpa_threshold, 'Automated Threshold (Weighted Median + MAD)', NULL, r.current_6h_spend,
         r.current_6h_volume, NULL
  FROM cpa_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'highCPA'
                               AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'performanceDecline', r.vertical_name, r.campaign_name, r.campaign_id, r.todays_roi, 'Today',
         r.effective_threshold, 'Controlled Threshold', NULL, r.todays_spend, NULL, r.base_threshold
  FROM pd_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'performanceDecline'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'performanceDecline', r.vertical_name, r.campaign_name, r.campaign_id, r.todays_roi, 'Today',
         r.benchmark, 'Last Week''s Avg ROI * {P.performance_decline_drop_factor}', NULL, r.todays_spend, NULL, NULL
  FROM pd_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'performanceDecline'
                              AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'fbToClickout', r.vertical_name, r.campaign_name, r.campaign_id, r.current_fb_to_clickout_rate,
         'Last 24 Hours', r.effective_threshold, 'Controlled Threshold', NULL, NULL, NULL, r.base_threshold
  FROM fb_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'fbToClickout'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'fbToClickout', r.vertical_name, r.campaign_name, r.campaign_id, r.current_fb_to_clickout_rate,
         'Last 24 Hours', r.benchmark, 'Last Week''s Avg Rate * {P.fb_to_clickout_drop_factor}', NULL, NULL, NULL, NULL
  FROM fb_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'fbToClickout'
                              AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'clickoutToConversion', r.vertical_name, r.campaign_name, r.campaign_id, r.todays_cr, 'Today',
         r.effective_threshold, 'Controlled Threshold', NULL, NULL, NULL, r.base_threshold
  FROM cr_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'clickoutToConversion'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'clickoutToConversion', r.vertical_name, r.campaign_name, r.campaign_id, r.todays_cr, 'Today',
         r.benchmark, 'Last Week''s Avg CR * {P.clickout_to_conversion_factor}', NULL, NULL, NULL, NULL
  FROM cr_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'clickoutToConversion'
                              AND m.mode = 'automated'
  WHERE r.fired
  UNION ALL
  SELECT 'highLpAbandonment', r.vertical_name, NULL, NULL, r.current_rate, 'Last 24 Hours',
         r.effective_threshold, 'Controlled Threshold', r.page, NULL, NULL, r.base_threshold
  FROM lp_ctrl r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'highLpAbandonment'
                              AND m.mode = 'controlled'
  WHERE r.fired
  UNION ALL
  SELECT 'highLpAbandonment', r.vertical_name, NULL, NULL, r.current_rate, 'Last 24 Hours',
         r.benchmark, 'Last Week''s Avg Rate * {P.lp_abandonment_benchmark_factor}', r.page, NULL, NULL, NULL
  FROM lp_auto r JOIN modes m ON m.vertical_name = r.vertical_name AND m.alert_name = 'highLpAbandonment'
                              AND m.mode = 'automated'
  WHERE r.fired)
"""

BODIES: dict[str, str] = {
    "load_facts": f"""
SELECT '{HOURLY}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {HOURLY}
UNION ALL SELECT '{DAILY}', CAST(COUNT(*) AS BIGINT) FROM {DAILY}
UNION ALL SELECT '{SESSIONS}', CAST(COUNT(*) AS BIGINT) FROM {SESSIONS}
UNION ALL SELECT '{FUNNEL}', CAST(COUNT(*) AS BIGINT) FROM {FUNNEL}""",
    "alert_config": "SELECT vertical_name, alert_name, base_threshold, percent_increase, automated FROM cfg",
    "alerts_all": "SELECT * FROM alerts",
    "alert_payload_json": """
SELECT $STAMP AS as_of,
       '["' || $STAMP || '","' || alert_name || '","' || vertical_name || '","' || COALESCE(campaign_id, 'N/A')
         || '","' || COALESCE(landing_page, 'N/A') || '"]' AS alert_key,
       alert_name, vertical_name, COALESCE(campaign_name, 'N/A') AS campaign_name,
       COALESCE(campaign_id, 'N/A') AS campaign_id, calculated_value_timeframe, benchmark_timeframe,
       COALESCE(landing_page, 'N/A') AS landing_page,
       CASE WHEN isfinite(calculated_value) THEN calculated_value END AS calculated_value,
       CASE WHEN isfinite(benchmark) THEN benchmark END AS benchmark, spend, CAST(leads AS DOUBLE) AS leads, base_threshold,
       spend IS NOT NULL AS spend_applies, leads IS NOT NULL AS leads_applies,
       calculated_value IS NOT NULL AND NOT isfinite(calculated_value) AS calculated_value_is_infinite
FROM alerts""",
    "alert_summary": """
SELECT alert_name, vertical_name, CAST(COUNT(*) AS BIGINT) AS alert_count FROM alerts GROUP BY 1, 2""",
    "active_campaigns_by_spend": "SELECT * FROM act_spend",
    "active_campaigns_by_sessions": "SELECT * FROM act_sessions",
    "active_campaigns": "SELECT * FROM act",
    "scope_to_active": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, a.vertical_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
        f"CAST(SUM(t.{measure}) AS DOUBLE) AS measure_sum FROM {name} t JOIN act a USING (campaign_id) GROUP BY 1, 2"
        for name, measure in ((HOURLY, "spend"), (DAILY, "spend"), (SESSIONS, "conversion_payout"),
                              (FUNNEL, "users_reached_step"))),
    "alert_modes": "SELECT * FROM modes",
    "effective_thresholds": """
SELECT vertical_name, alert_name, base_threshold, percent_increase, effective_threshold
FROM modes WHERE effective_threshold IS NOT NULL""",
    "conversions_last_hour": "SELECT * FROM vd_cur",
    "spend_today": "SELECT * FROM spend_today",
    "same_hour_7d_avg": "SELECT * FROM vd_avg",
    "volume_drop_controlled": "SELECT * FROM vd_ctrl",
    "volume_drop_automated": "SELECT * FROM vd_auto",
    "last_conversion": """
SELECT vertical_name, strftime(last_dt, '%Y-%m-%d %H:%M:%S.%f') AS last_conversion_dt FROM fi_last""",
    "minutes_since_conversion": "SELECT * FROM fi_min",
    "conversion_gaps": "SELECT * FROM fi_gaps",
    "gap_median": "SELECT * FROM fi_med",
    "gap_threshold": "SELECT * FROM fi_thr",
    "flow_interruption_controlled": "SELECT * FROM fi_ctrl",
    "flow_interruption_automated": "SELECT * FROM fi_auto",
    "cpa_spend_6h": "SELECT a.vertical_name, x.* FROM act a JOIN cpa_sp x USING (campaign_id)",
    "cpa_volume_6h": "SELECT a.vertical_name, x.* FROM act a JOIN cpa_vo x USING (campaign_id)",
    "cpa_current": "SELECT a.vertical_name, x.* FROM act a JOIN cpa_cur x USING (campaign_id)",
    "cpa_spend_history": """
SELECT a.vertical_name, x.campaign_id, strftime(x.ws, '%Y-%m-%d %H:%M:%S') AS time_window_start, x.window_spend
FROM act a JOIN cpa_hsp x USING (campaign_id)""",
    "cpa_volume_history": """
SELECT a.vertical_name, x.campaign_id, strftime(x.ws, '%Y-%m-%d %H:%M:%S') AS time_window_start, x.window_volume
FROM act a JOIN cpa_hvo x USING (campaign_id)""",
    "cpa_history": """
SELECT a.vertical_name, x.campaign_id, strftime(x.ws, '%Y-%m-%d %H:%M:%S') AS time_window_start,
       x.window_spend, x.window_volume, x.cpa
FROM act a JOIN cpa_hist x USING (campaign_id)""",
    "cpa_trimmed": """
SELECT a.vertical_name, x.campaign_id, strftime(x.ws, '%Y-%m-%d %H:%M:%S') AS time_window_start,
       x.cpa, x.window_volume
FROM act a JOIN cpa_trim x USING (campaign_id)""",
    "weighted_median": """
SELECT a.vertical_name, x.campaign_id, x.weighted_median_cpa FROM act a JOIN cpa_thr x USING (campaign_id)""",
    "weighted_mad": """
SELECT a.vertical_name, x.campaign_id, x.weighted_median_cpa, x.weighted_mad_cpa
FROM act a JOIN cpa_thr x USING (campaign_id)""",
    "cpa_threshold": "SELECT a.vertical_name, x.* FROM act a JOIN cpa_thr x USING (campaign_id)",
    "high_cpa_controlled": "SELECT * FROM cpa_ctrl_f",
    "high_cpa_automated": "SELECT * FROM cpa_auto",
    "roi_today": "SELECT a.vertical_name, x.* FROM act a JOIN pd_t x USING (campaign_id)",
    "roi_last_week": "SELECT a.vertical_name, x.* FROM act a JOIN pd_w x USING (campaign_id)",
    "performance_decline_controlled": "SELECT * FROM pd_ctrl",
    "performance_decline_automated": "SELECT * FROM pd_auto",
    "clickout_rate_24h": "SELECT a.vertical_name, x.* FROM act a JOIN fb_t x USING (campaign_id)",
    "clickout_rate_prev_week": "SELECT a.vertical_name, x.* FROM act a JOIN fb_w x USING (campaign_id)",
    "fb_to_clickout_controlled": "SELECT * FROM fb_ctrl",
    "fb_to_clickout_automated": "SELECT * FROM fb_auto",
    "conversion_rate_today": "SELECT a.vertical_name, x.* FROM act a JOIN cr_t x USING (campaign_id)",
    "conversion_rate_week_ago": "SELECT a.vertical_name, x.* FROM act a JOIN cr_w x USING (campaign_id)",
    "clickout_to_conversion_controlled": "SELECT * FROM cr_ctrl",
    "clickout_to_conversion_automated": "SELECT * FROM cr_auto",
    "lp_started_24h": "SELECT * FROM lp_st_t",
    "lp_success_24h": "SELECT * FROM lp_su_t",
    "lp_abandonment_24h": "SELECT * FROM lp_t",
    "lp_abandonment_prev_week": "SELECT * FROM lp_w",
    "lp_abandonment_controlled": "SELECT * FROM lp_ctrl",
    "lp_abandonment_automated": "SELECT * FROM lp_auto",
    "alert_modes_observed": """
SELECT * REPLACE (CASE WHEN level = 'campaign' AND mode = 'controlled' THEN 'inert' ELSE mode END AS mode) FROM modes""",
    "same_hour_7d_avg_zero_fill": """
SELECT v.vertical_name, COALESCE(SUM(x.n), 0) / 7.0 AS same_hour_avg, CAST(COUNT(x.d) AS BIGINT) AS days_with_conversions
FROM verticals v LEFT JOIN vd_days x USING (vertical_name) GROUP BY 1""",
    "cpa_history_without_today": f"""
SELECT a.vertical_name, campaign_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS time_window_start, sp.window_spend, vo.window_volume,
       CASE WHEN vo.window_volume = 0 THEN $INF ELSE sp.window_spend / vo.window_volume END AS cpa
FROM (SELECT campaign_id, date_trunc('hour', "timestamp" - INTERVAL 6 HOUR) AS ws, SUM(spend) AS window_spend
      FROM {HOURLY} WHERE "timestamp" >= $NOW_M28D AND "timestamp" < $TODAY_TS AND dayofweek("timestamp") = dayofweek($NOW)
      GROUP BY 1, 2) sp
FULL JOIN (SELECT campaign_id, date_trunc('hour', conversion_dt - INTERVAL 6 HOUR) AS ws,
                  CAST(COUNT(session_id) AS BIGINT) AS window_volume
           FROM {SESSIONS} WHERE conversion_dt >= $NOW_M28D AND conversion_dt < $TODAY_TS
             AND dayofweek(conversion_dt) = dayofweek($NOW) GROUP BY 1, 2) vo USING (campaign_id, ws)
JOIN act a USING (campaign_id)""",
    "roi_today_missing_zero": """
SELECT a.vertical_name, x.campaign_id, COALESCE(x.todays_revenue, 0.0) AS todays_revenue,
       COALESCE(x.todays_spend, 0.0) AS todays_spend,
       CASE WHEN COALESCE(x.todays_spend, 0.0) = 0 THEN $INF ELSE COALESCE(x.todays_revenue, 0.0) / x.todays_spend END AS todays_roi
FROM act a JOIN pd_t x USING (campaign_id)""",
}


# Queries that reach the same rows by another way.
BODIES |= {"alerts_published": BODIES["alert_payload_json"], "alerts_all_incremental": BODIES["alerts_all"], "alerts_all_bitmaps": BODIES["alerts_all"],
           "clickout_rate_24h_bitmaps": BODIES["clickout_rate_24h"], "clickout_rate_prev_week_bitmaps": BODIES["clickout_rate_prev_week"]}

BODIES["rollup_store_rows"] = f"""
SELECT 'spend' AS table_name, CAST(NULL AS VARCHAR) AS kind, COUNT(*) AS stored_rows, CAST(SUM(n) AS BIGINT) AS fact_rows FROM (
  SELECT COUNT(*) AS n FROM {HOURLY} WHERE "timestamp" >= $NOW_M28D AND "timestamp" < $NOW
  GROUP BY vertical, campaign_id, campaign_name, date_trunc('hour', "timestamp"))
UNION ALL SELECT 'sessions', kind, COUNT(*), CAST(SUM(n) AS BIGINT) FROM (
  SELECT 'conversion' AS kind, COUNT(*) AS n FROM {SESSIONS} WHERE conversion_dt >= $NOW_M28D AND conversion_dt < $NOW
  GROUP BY campaign_id, date_trunc('hour', conversion_dt)
  UNION ALL SELECT 'second', COUNT(*) FROM {SESSIONS} WHERE conversion_dt >= $NOW_M28D AND conversion_dt < $NOW
  GROUP BY campaign_id, date_trunc('second', conversion_dt)
  UNION ALL SELECT 'start', COUNT(*) FROM {SESSIONS} WHERE session_dt >= $NOW_M28D AND session_dt < $NOW
  GROUP BY campaign_id, page, date_trunc('hour', session_dt)
  UNION ALL SELECT 'clickout', COUNT(*) FROM {SESSIONS} WHERE session_dt >= $NOW_M28D AND session_dt < $NOW AND postback_id IS NOT NULL
  GROUP BY campaign_id, session_id, date_trunc('hour', session_dt)
  UNION ALL SELECT 'seen', COUNT(*) FROM {SESSIONS} WHERE "timestamp" >= $NOW_M28D AND "timestamp" < $NOW
  GROUP BY vertical, campaign_id, date_trunc('hour', "timestamp")) GROUP BY kind
UNION ALL SELECT 'daily', NULL, COUNT(*), NULL FROM (SELECT 1 FROM {DAILY} WHERE date >= CAST($NOW_M28D AS DATE) AND date <= $TODAY GROUP BY campaign_id, date)
UNION ALL SELECT 'funnel', NULL, COUNT(*), NULL FROM (
  SELECT 1 FROM {FUNNEL} WHERE interaction_type = 'loader' AND date >= CAST($NOW_M28D AS DATE) AND date <= $TODAY GROUP BY campaign_id, page, date)"""


#: The DOUBLE columns of each query, which both engines round to 6 decimals.
DOUBLES: dict[str, str] = {
    "alert_modes_observed": "base_threshold percent_increase effective_threshold",
    "same_hour_7d_avg_zero_fill": "same_hour_avg",
    "cpa_history_without_today": "window_spend cpa",
    "roi_today_missing_zero": "todays_revenue todays_spend todays_roi",
    "alert_config": "base_threshold percent_increase",
    **dict.fromkeys(("alerts_all", "alerts_all_incremental", "alerts_all_bitmaps"), "calculated_value benchmark spend base_threshold"),
    "clickout_rate_24h_bitmaps": "current_fb_to_clickout_rate",
    "clickout_rate_prev_week_bitmaps": "last_week_fb_to_clickout_rate",
    **dict.fromkeys(("alert_payload_json", "alerts_published"), "calculated_value benchmark spend leads base_threshold"),
    "active_campaigns_by_spend": "recent_spend",
    "scope_to_active": "measure_sum",
    "alert_modes": "base_threshold percent_increase effective_threshold",
    "effective_thresholds": "base_threshold percent_increase effective_threshold",
    "spend_today": "spend_today",
    "same_hour_7d_avg": "same_hour_avg",
    "volume_drop_controlled": "spend_today base_threshold effective_threshold",
    "volume_drop_automated": "spend_today same_hour_avg benchmark",
    "minutes_since_conversion": "minutes_since_conversion",
    "conversion_gaps": "gap_minutes",
    "gap_median": "median_gap_minutes",
    "gap_threshold": "median_gap_minutes dynamic_threshold",
    "flow_interruption_controlled": "minutes_since_conversion spend_today base_threshold effective_threshold",
    "flow_interruption_automated": "minutes_since_conversion spend_today median_gap_minutes dynamic_threshold",
    "cpa_spend_6h": "current_6h_spend",
    "cpa_current": "current_6h_spend current_6h_cpa",
    "cpa_spend_history": "window_spend",
    "cpa_history": "window_spend cpa",
    "cpa_trimmed": "cpa",
    "weighted_median": "weighted_median_cpa",
    "weighted_mad": "weighted_median_cpa weighted_mad_cpa",
    "cpa_threshold": "weighted_median_cpa weighted_mad_cpa high_cpa_threshold",
    "high_cpa_controlled": "current_6h_cpa current_6h_spend base_threshold effective_threshold",
    "high_cpa_automated": "current_6h_spend current_6h_cpa weighted_median_cpa weighted_mad_cpa high_cpa_threshold",
    "roi_today": "todays_revenue todays_spend todays_roi",
    "roi_last_week": "last_week_revenue last_week_spend last_week_roi",
    "performance_decline_controlled": "todays_roi todays_spend base_threshold effective_threshold",
    "performance_decline_automated": "todays_roi todays_spend last_week_roi last_week_spend benchmark",
    "clickout_rate_24h": "current_fb_to_clickout_rate",
    "clickout_rate_prev_week": "last_week_fb_to_clickout_rate",
    "fb_to_clickout_controlled": "current_fb_to_clickout_rate base_threshold effective_threshold",
    "fb_to_clickout_automated": "current_fb_to_clickout_rate last_week_fb_to_clickout_rate benchmark",
    "conversion_rate_today": "todays_cr",
    "conversion_rate_week_ago": "last_week_cr",
    "clickout_to_conversion_controlled": "todays_cr base_threshold effective_threshold",
    "clickout_to_conversion_automated": "todays_cr last_week_cr benchmark",
    "lp_abandonment_24h": "current_rate",
    "lp_abandonment_prev_week": "last_week_rate",
    "lp_abandonment_controlled": "current_rate base_threshold effective_threshold",
    "lp_abandonment_automated": "current_rate last_week_rate benchmark",
}


def _render(text: str, now: datetime = NOW) -> str:
    constants = _constants(now)
    # longest names first so $NOW does not eat $NOW_M1H
    for key in sorted(constants, key=len, reverse=True):
        text = text.replace("$" + key, constants[key])
    return text


def _at(name: str, now: datetime) -> str:
    return "WITH " + _render(CTES, now).strip() + "\n" + _rounded(_render(BODIES[name], now).strip(), DOUBLES.get(name, "").split())


def _backfill() -> str:
    """alerts_all at each of the fixture's instants."""
    return "\nUNION ALL\n".join(
        f"SELECT *, '{now.strftime('%Y-%m-%d %H:%M:%S')}' AS as_of FROM (\n{_at('alerts_all', now)}) AS q{k}"
        for k, now in enumerate(datetime.fromisoformat(t) for t in fixture.BACKFILL))


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB SQL over the pre-registered ``events`` view."""
    return {name: _at(name, NOW) for name in BODIES} | {"alerts_backfill": _backfill()}


def _rounded(body: str, names: list[str]) -> str:
    if not names:
        return body
    return f"SELECT * REPLACE ({', '.join(f'round({n}, 6) AS {n}' for n in names)}) FROM (\n{body}) AS q"
