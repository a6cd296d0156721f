"""Queries: score monitoring over the prediction log (window, baseline, drift, KS)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import monitoring as MO
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.sources import fixtures as fx

W = MO.WINDOW


def _log(spark, sf_dir):
    return fx.prediction_log(spark, sf_dir)


def _as_of(log) -> int:
    """Baseline taken when the middle batch was the latest one (one value, read once)."""
    return int(log.agg(F.max("batch_id")).first()[0]) // 2


def _baseline(spark, sf_dir):
    log = _log(spark, sf_dir)
    return log, MO.baseline_snapshot(log, _as_of(log), W)


def _sql(body: str) -> str:
    return fx.with_views(body, "prediction_log")


_ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
                1.48851587, -0.82215223, 0.17087277]


def _sql_normal_sf(z: str) -> str:
    x = f"(({z}) / sqrt(2e0))"
    t = f"(1e0 / (1e0 + 0.5e0 * abs({x})))"
    poly = f"({_ERFC_COEFFS[-1]}e0)"
    for c in reversed(_ERFC_COEFFS[:-1]):
        poly = f"({c}e0 + {t} * {poly})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(0.5e0 * CASE WHEN {x} >= 0 THEN {ans} ELSE 2e0 - {ans} END)"


_WIN = f"win AS (SELECT * FROM prediction_log ORDER BY ts DESC, seq DESC LIMIT {W})"
_BASE = f"""asofb AS (SELECT CAST(floor(max(batch_id) / 2) AS BIGINT) AS b FROM prediction_log),
past AS (SELECT * FROM prediction_log WHERE batch_id <= (SELECT b FROM asofb)),
pwin AS (SELECT * FROM past ORDER BY ts DESC, seq DESC LIMIT {W}),
base AS (SELECT avg(score) AS baseline_mean, stddev_pop(score) AS baseline_std, count(score) AS baseline_count,
  (SELECT max(batch_id) FROM past) AS baseline_batch FROM pwin)"""
_CUR = "cur AS (SELECT avg(score) AS mean FROM win)"
_Z = "CASE WHEN baseline_std > 0 THEN abs((SELECT mean FROM cur) - baseline_mean) / baseline_std END"
_PERF = f"""perf AS (SELECT 'model_drift' AS shift_type, coalesce({_Z} > 2.0, false) AS has_shift, {_Z} AS statistic,
  {_sql_normal_sf(_Z)} AS p_value, 2.0e0 AS threshold, baseline_mean, baseline_std,
  (SELECT mean FROM cur) AS current_mean,
  CASE WHEN baseline_std IS NULL OR baseline_std <= 0 THEN 'zero baseline std' END AS reason FROM base)"""
_KS = """ka AS (SELECT score FROM prediction_log WHERE batch_id = (SELECT baseline_batch FROM base)),
kb AS (SELECT score FROM prediction_log WHERE batch_id = (SELECT max(batch_id) FROM prediction_log)),
kp AS (SELECT score, sum(ia) AS n_a, sum(ib) AS n_b FROM (SELECT score, 1 AS ia, 0 AS ib FROM ka
  UNION ALL SELECT score, 0, 1 FROM kb) WHERE score IS NOT NULL GROUP BY score),
kc AS (SELECT *, sum(n_a) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS ca,
  sum(n_b) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cb FROM kp),
kn AS (SELECT CAST(sum(n_a) AS DOUBLE) AS na, CAST(sum(n_b) AS DOUBLE) AS nb FROM kp),
kd AS (SELECT max(abs(ca / (SELECT na FROM kn) - cb / (SELECT nb FROM kn))) AS statistic FROM kc),
kl AS (SELECT statistic, sqrt((SELECT na * nb / (na + nb) FROM kn)) * statistic AS lam FROM kd),
ks AS (SELECT 'data_shift' AS shift_type, statistic, CAST((SELECT na FROM kn) AS BIGINT) AS n_a,
  CAST((SELECT nb FROM kn) AS BIGINT) AS n_b,
  CASE WHEN (SELECT greatest(na, nb) FROM kn) <= 10000 THEN (WITH RECURSIVE
    kz AS (SELECT CAST(na AS BIGINT) AS a, CAST(nb AS BIGINT) AS b, CAST(round(statistic * na * nb) AS BIGINT) AS d
      FROM kn, kd),
    kx AS (SELECT 0 AS s, [CASE WHEN i = 0 THEN 1e0 ELSE 0e0 END FOR i IN range(0, a + 1)] AS p, 0e0 AS o, a, b, d FROM kz
      UNION ALL
      SELECT s + 1, [CASE WHEN abs(i * (a + b) - (s + 1) * a) < d THEN q[i + 1] ELSE 0e0 END FOR i IN range(0, a + 1)],
        o + list_sum([CASE WHEN abs(i * (a + b) - (s + 1) * a) >= d THEN q[i + 1] ELSE 0e0 END FOR i IN range(0, a + 1)]),
        a, b, d
      FROM (SELECT s, o, a, b, d, [p[i + 1] * greatest(b - (s - i), 0) / (a + b - s)
          + CASE WHEN i > 0 THEN p[i] * (a - (i - 1)) / (a + b - s) ELSE 0e0 END FOR i IN range(0, a + 1)] AS q
        FROM kx WHERE s < a + b))
    SELECT max(CASE WHEN d <= 0 THEN 1e0 ELSE least(1e0, o) END) FROM kx WHERE s = a + b)
  WHEN lam < 0.2 THEN 1e0 ELSE least(1e0, greatest(0e0, 2e0 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * k * k * lam * lam))))) END AS p_value
  FROM kl)"""


@register("recent_window", _sql(f"WITH {_WIN} SELECT seq, batch_id, round(score, 6) AS score FROM win"))
def q_recent(spark, sf_dir):
    return round_doubles(MO.recent_window(_log(spark, sf_dir), W).select("seq", "batch_id", "score"))


@register("score_statistics", _sql(f"""WITH {_WIN}
SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min,
  round(max(score), 6) AS max, count(score) AS count FROM win"""))
def q_score_stats(spark, sf_dir):
    return round_doubles(MO.score_stats(MO.recent_window(_log(spark, sf_dir), W)))


@register("baseline_snapshot", _sql(f"""WITH {_BASE}
SELECT round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std, baseline_count,
  baseline_batch FROM base"""))
def q_baseline(spark, sf_dir):
    return round_doubles(_baseline(spark, sf_dir)[1])


@register("performance_drift", _sql(f"""WITH {_WIN}, {_BASE}, {_CUR}, {_PERF}
SELECT shift_type, has_shift, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, threshold,
  round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
  round(current_mean, 6) AS current_mean, reason FROM perf"""))
def q_perf_drift(spark, sf_dir):
    log, base = _baseline(spark, sf_dir)
    return round_doubles(MO.performance_drift(MO.score_stats(MO.recent_window(log, W)), base))


@register("data_shift_ks", _sql(f"""WITH {_BASE}, {_KS}
SELECT shift_type, p_value < 0.05 AS has_shift, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  0.05e0 AS threshold, n_a, n_b FROM ks"""))
def q_ks(spark, sf_dir):
    log, base = _baseline(spark, sf_dir)
    return round_doubles(MO.data_shift(log, base))


@register("check_shifts", _sql(f"""WITH {_WIN}, {_BASE}, {_CUR}, {_PERF}, {_KS}
SELECT shift_type, has_shift, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, threshold FROM perf
UNION ALL
SELECT shift_type, p_value < 0.05, round(statistic, 6), round(p_value, 6), 0.05e0 FROM ks"""))
def q_check_shifts(spark, sf_dir):
    log, base = _baseline(spark, sf_dir)
    return round_doubles(MO.check_shifts(log, base))


@register("monitoring_summary", _sql(f"""WITH {_WIN}
SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min,
  round(max(score), 6) AS max, count(score) AS count, true AS has_baseline, {W} AS window_size,
  least((SELECT count(*) FROM prediction_log), {W}) AS history_size,
  (SELECT count(DISTINCT batch_id) FROM prediction_log) AS metrics_history_size FROM win"""))
def q_monitoring_summary(spark, sf_dir):
    log, base = _baseline(spark, sf_dir)
    return round_doubles(MO.monitoring_summary(log, base, W))
