"""The same results in DuckDB SQL, written from the definitions and independent of the operators."""

from __future__ import annotations

T0, T1 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-30 23:30:00'"
SPLIT, NOW = "TIMESTAMP '2024-01-25 00:00:00'", "TIMESTAMP '2024-01-28 12:00:00'"
TODAY = "DATE '2024-01-28'"
FEEDER = "'Z' || lpad(CAST(user_id // 10 AS VARCHAR), 7, '0')"
LAGS = {"REQUIREMENT_LAG_1D": 24, "REQUIREMENT_LAG_2D": 48, "REQUIREMENT_LAG_3D": 72, "REQ_LAST168H": 168,
        "REQ_LAST336H": 336, "REQ_LAST504H": 504, "REQ_LAST672H": 672}
MODELS = {"M1": "pred_m1", "M2": "pred_m2", "M3": "pred_m3", "Ensemble_M1_M2_M3": "pred_ensemble",
          "Ensemble_M1_M2": "pred_ensemble_m1_m2"}
STANDALONE = {"M1": "pred_m1", "M2": "pred_m2", "M3": "pred_m3", "Ensemble": "pred_ensemble"}
FEATURES = ("REQUIREMENT_LAG_3D", "REQ_LAST168H", "REQ_LAST336H", "REQ_LAST504H", "REQ_LAST672H")
IMPUTED = ("REQUIREMENT_LAG_1D", "REQUIREMENT_LAG_3D", "REQ_LAST168H", "REQ_LAST336H")
P5 = ("pred_m1", "pred_m2", "pred_m3", "pred_ensemble", "pred_ensemble_m1_m2")


def _ape(a: str, p: str) -> str:
    return f"abs({a} - {p}) / greatest(abs({a}), 1e-6) * 100"


def _mean(cols: tuple[str, ...], weights: tuple[float, ...]) -> str:
    top = " + ".join(f"{w}::DOUBLE * coalesce({c}, 0)" for c, w in zip(cols, weights))
    low = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE {w}::DOUBLE END" for c, w in zip(cols, weights))
    return f"CASE WHEN ({low}) > 0 THEN ({top}) / nullif({low}, 0) END"


def _r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


ENS = (f"{_mean(('pred_m1', 'pred_m2', 'pred_m3'), (0.5, 0.3, 0.2))} AS pred_ensemble, "
       f"{_mean(('pred_m1', 'pred_m2'), (0.5, 0.5))} AS pred_ensemble_m1_m2")

CTES = {
    "sums": f"""SELECT {FEEDER} AS zone, time_bucket(INTERVAL 30 MINUTES, ts) AS for_date,
        round(sum(value) * 64) / 64 AS requirement FROM events GROUP BY 1, 2""",
    "f1": f"""SELECT z.zone, g.for_date, coalesce(s.requirement, 0.0) AS requirement
        FROM (SELECT DISTINCT zone FROM sums) z
        CROSS JOIN (SELECT unnest(generate_series({T0}, {T1}, INTERVAL 30 MINUTES)) AS for_date) g
        LEFT JOIN sums s ON s.zone = z.zone AND s.for_date = g.for_date""",
    "f1m": f"""SELECT zone, for_date, CASE WHEN for_date < {SPLIT} THEN 'train' ELSE 'test' END AS split,
        CASE WHEN for_date >= {NOW} THEN 0.0 ELSE requirement END AS requirement FROM f1""",
    "f4": "SELECT f.zone, f.for_date, f.split, f.requirement, "
          + ", ".join(f"l{h}.requirement AS {n}" for n, h in LAGS.items())
          + " FROM f1m f " + " ".join(
              f"LEFT JOIN f1m l{h} ON l{h}.zone = f.zone AND l{h}.for_date = f.for_date - INTERVAL {h} HOURS"
              for h in LAGS.values()),
    "f5b": """SELECT zone, for_date, requirement AS actual, REQ_LAST168H AS pred_m1,
        (REQ_LAST168H + REQ_LAST336H) / 2 AS pred_m2,
        CASE WHEN hour(for_date) BETWEEN 9 AND 21 THEN 1 ELSE 0 END AS is_peak FROM f4 WHERE split = 'test'""",
    "f5": """SELECT zone, for_date, actual, pred_m1, pred_m2,
        CASE WHEN count(*) OVER w = 6 THEN avg(pred_m1) OVER w END AS pred_m3, is_peak FROM f5b
        WINDOW w AS (PARTITION BY zone ORDER BY for_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "f5e": f"SELECT *, {ENS} FROM f5",
    "f5s": f"""SELECT zone AS reg, for_date, CASE WHEN abs(actual) >= 1 THEN actual END AS actual,
        pred_m1, pred_m2, pred_m3, {_mean(('pred_m1', 'pred_m2', 'pred_m3'), (1, 1, 1))} AS pred_ensemble,
        is_peak FROM f5""",
    "f7": """SELECT reg, for_date, actual, is_peak, 'org' AS config, pred_m1 AS pred FROM f5s
        UNION ALL SELECT reg, for_date, actual, is_peak, 'tuned', pred_m2 FROM f5s""",
    "runs": """SELECT * FROM (VALUES ('20240126_060000', TIMESTAMP '2024-01-26 06:00:00', CAST(1.0 AS DOUBLE)),
        ('20240127_060000', TIMESTAMP '2024-01-27 06:00:00', CAST(1.02 AS DOUBLE)),
        ('20240127_180000', TIMESTAMP '2024-01-27 18:00:00', CAST(0.98 AS DOUBLE))) t(run_timestamp, run_at, f)""",
    "f6b": """SELECT p.zone, p.for_date, CASE WHEN p.for_date >= r.run_at THEN 0.0 ELSE p.actual END AS actual,
        p.pred_m1 * r.f AS pred_m1, p.pred_m2 * r.f AS pred_m2, p.pred_m3 * r.f AS pred_m3,
        r.run_timestamp, CAST(strptime(r.run_timestamp, '%Y%m%d_%H%M%S') AS DATE) AS run_date
        FROM f5 p CROSS JOIN runs r""",
    "f6": f"SELECT *, {ENS} FROM f6b",
    "f3": f"""SELECT zone, split,
        CASE WHEN minute(for_date) = 30 AND day(for_date) = 13 THEN 'not a date'
             WHEN day(for_date) = 14 THEN strftime(for_date, '%-d/%-m/%Y %-H:%M')
             ELSE strftime(for_date, '%d/%m/%Y %H:%M:%S') END AS for_date_str,
        CASE WHEN minute(for_date) = 30 AND day(for_date) = 13 THEN NULL ELSE for_date END AS for_date,
        CASE WHEN hour(for_date) = 3 AND day(for_date) = 5 THEN 'n/a'
             WHEN hour(for_date) = 4 AND day(for_date) = 5 THEN 'Infinity'
             ELSE CAST(CAST(requirement AS DECIMAL(18, 6)) AS VARCHAR) END AS requirement,
        hour(for_date) >= 18 AS flag, zone AS reg FROM f1m""",
    "f3n": "SELECT zone, split, for_date, TRY_CAST(requirement AS DOUBLE) AS x FROM f3",
    "rd": "SELECT event_type AS zone, ts AS for_date, event_id, round(value * 64) / 64 AS requirement FROM events",
    "od": """SELECT r_name AS zone, o_orderdate AS for_date, o_orderkey,
        CASE WHEN o_orderdate < TIMESTAMP '2001-01-01 00:00:00' THEN 'train' ELSE 'test' END AS split,
        round(o_totalprice * 64) / 64 AS requirement, o_orderpriority, o_orderstatus
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "hol": """SELECT unnest([DATE '2024-01-01', DATE '2024-01-16', DATE '2024-01-26']) AS d""",
    "reg": f"SELECT DISTINCT {FEEDER} AS zone FROM events UNION ALL SELECT 'Z_EMPTY'",
    "imp": "SELECT zone, 'corr' AS model, feature, importance FROM (" + " UNION ALL ".join(
        f"SELECT zone, '{f}' AS feature, coalesce(covar_pop({f}, requirement) * covar_pop({f}, requirement) / "
        f"nullif(var_pop({f}) * var_pop(CASE WHEN {f} IS NOT NULL THEN requirement END), 0), 0) AS importance "
        "FROM f4 GROUP BY zone" for f in FEATURES) + ")",
    "met": " UNION ALL ".join(
        f"""SELECT zone, '{m}' AS model,
        avg({_ape('actual', p)}) FILTER (abs(actual) >= 1 AND {p} IS NOT NULL) AS MAPE,
        avg(abs({p} - actual)) FILTER (abs(actual) >= 1) AS MAE,
        sqrt(avg(({p} - actual) * ({p} - actual)) FILTER (abs(actual) >= 1)) AS RMSE,
        avg({p} - actual) FILTER (abs(actual) >= 1) AS BIAS,
        count(*) AS n_rows_total, count({p}) FILTER (abs(actual) >= 1) AS n_rows_scored,
        count({p}) FILTER (abs(actual) < 1) AS n_rows_excluded_zero_actual FROM f5e GROUP BY zone"""
        for m, p in MODELS.items()),
    "metall": """SELECT * FROM met UNION ALL SELECT 'ALL', model,
        sum(MAPE * n_rows_scored) / nullif(sum(n_rows_scored), 0),
        sum(MAE * n_rows_scored) / nullif(sum(n_rows_scored), 0),
        sum(RMSE * n_rows_scored) / nullif(sum(n_rows_scored), 0),
        sum(BIAS * n_rows_scored) / nullif(sum(n_rows_scored), 0),
        sum(n_rows_total), sum(n_rows_scored), sum(n_rows_excluded_zero_actual) FROM met GROUP BY model""",
    "met4": f"""SELECT reg, config, 'Ensemble' AS model, round(avg({_ape('actual', 'pred')}), 4) AS MAPE,
        round(avg(abs(pred - actual)), 4) AS MAE, round(sqrt(avg((pred - actual) * (pred - actual))), 4) AS RMSE,
        round(avg(pred - actual), 4) AS BIAS FROM f7 WHERE actual IS NOT NULL AND pred IS NOT NULL GROUP BY reg, config""",
    "cmp": """SELECT a.reg, a.model, a.MAPE AS MAPE_org, b.MAPE AS MAPE_tuned, round(a.MAPE - b.MAPE, 4) AS MAPE_diff,
        CASE WHEN a.MAPE < b.MAPE THEN 'org' WHEN b.MAPE < a.MAPE THEN 'tuned' ELSE 'tie' END AS winner,
        a.MAE AS MAE_org, b.MAE AS MAE_tuned, a.BIAS AS BIAS_org, b.BIAS AS BIAS_tuned
        FROM met4 a JOIN met4 b USING (reg, model) WHERE a.config = 'org' AND b.config = 'tuned'""",
    "corr": """SELECT zone, -avg(pred_ensemble - actual) AS correction, count(*) AS n FROM f6
        WHERE abs(actual) >= 1 GROUP BY zone HAVING count(*) >= 24""",
    "lag2": """SELECT zone, for_date, split, requirement,
        coalesce(REQ_LAST168H, median(REQ_LAST168H) OVER (PARTITION BY zone)) AS REQ_LAST168H,
        coalesce(REQ_LAST336H, median(REQ_LAST336H) OVER (PARTITION BY zone)) AS REQ_LAST336H
        FROM f4 WHERE split = 'train'""",
}


def _shift(source: str) -> str:
    """Long shift table over (zone, for_date, split, requirement)."""
    return f"""
    tr AS (SELECT zone, avg(requirement) AS m, stddev_samp(requirement) AS s FROM {source}
           WHERE split = 'train' AND requirement IS NOT NULL GROUP BY zone),
    te AS (SELECT zone, avg(requirement) AS m, count(*) AS n FROM {source}
           WHERE split = 'test' AND abs(requirement) >= 1 GROUP BY zone),
    mo AS (SELECT DISTINCT zone, month(for_date) AS mm FROM {source} WHERE split = 'test' AND abs(requirement) >= 1),
    sm AS (SELECT f.zone, avg(requirement) AS m, stddev_samp(requirement) AS s, count(*) AS n FROM {source} f
           JOIN mo ON mo.zone = f.zone AND mo.mm = month(f.for_date) WHERE split = 'train' GROUP BY f.zone),
    shift AS (
        SELECT zone, 'train_mean' AS metric, round(m, 2) AS value FROM tr
        UNION ALL SELECT zone, 'train_std', round(s, 2) FROM tr
        UNION ALL SELECT zone, 'test_realized_mean', round(te.m, 2) FROM tr JOIN te USING (zone)
        UNION ALL SELECT zone, 'test_realized_n_rows', CAST(te.n AS DOUBLE) FROM tr JOIN te USING (zone)
        UNION ALL SELECT zone, 'z_score_vs_train', round(CASE WHEN tr.s > 0 THEN (te.m - tr.m) / tr.s END, 3)
            FROM tr JOIN te USING (zone)
        UNION ALL SELECT zone, 'same_month_history_mean', round(sm.m, 2) FROM sm JOIN te USING (zone) WHERE sm.n > 1
        UNION ALL SELECT zone, 'z_score_vs_same_month_history',
            round(CASE WHEN sm.s > 0 THEN (te.m - sm.m) / sm.s END, 3) FROM sm JOIN te USING (zone) WHERE sm.n > 1)"""


FLAGS = (_shift("f1m") + """,
    flags AS (SELECT zone, value AS z_score, CASE WHEN abs(value) >= 0.8 THEN 'critical' ELSE 'warning' END AS severity
              FROM shift WHERE metric = 'z_score_vs_train' AND abs(value) >= 0.5)""")

DRIFT = f"""
    recent AS (SELECT zone, round(avg(CASE WHEN abs(actual) >= 1 THEN {_ape('actual', 'pred_ensemble')} END), 4) AS m
               FROM f6 WHERE for_date >= {NOW} - INTERVAL 3 DAYS GROUP BY zone),
    drift AS (SELECT reg.zone, coalesce(m > 5, false) AS drift, m AS recent_mape,
        CASE WHEN recent.zone IS NULL THEN 'insufficient recent data' WHEN m IS NULL THEN 'MAPE nan% OK'
             WHEN m > 5 THEN 'MAPE ' || CAST(CAST(CAST(m AS DECIMAL(18, 4)) AS DECIMAL(18, 2)) AS VARCHAR)
                || '% > threshold 5.0% over last 3 days'
             ELSE 'MAPE ' || CAST(CAST(CAST(m AS DECIMAL(18, 4)) AS DECIMAL(18, 2)) AS VARCHAR) || '% OK' END AS reason
        FROM reg LEFT JOIN recent USING (zone))"""

PLAN = f"""
    lastrun AS (SELECT zone, max(run_timestamp) AS rt FROM f6 WHERE run_date < {TODAY} GROUP BY zone),
    plan AS (SELECT l.zone,
        round(CASE WHEN count(h.for_date) FILTER (CAST(h.for_date AS DATE) = {TODAY}) > 0
              THEN coalesce(sum(pred_ensemble) FILTER (CAST(h.for_date AS DATE) = {TODAY}), 0) END, 2) AS plan_total_mw,
        round(max(pred_ensemble) FILTER (CAST(h.for_date AS DATE) = {TODAY}), 2) AS plan_peak_mw,
        CAST(max(h.run_date) AS VARCHAR) AS plan_made_on
        FROM lastrun l JOIN f6 h ON h.zone = l.zone AND h.run_timestamp = l.rt GROUP BY l.zone)"""


def _peak(value: str, cond: str) -> str:
    """Time of the largest value, earliest on ties, as text."""
    order = f"{{'v': {value}, 't': -epoch_us(for_date)}}"
    return f"strftime(arg_max(for_date, {order}) FILTER ({cond} AND {value} IS NOT NULL), '%Y-%m-%d %H:%M:%S')"


IS_TODAY = f"CAST(for_date AS DATE) = {TODAY}"
IS_YESTERDAY = f"CAST(for_date AS DATE) = {TODAY} - 1"
LINE = ("regr_slope(requirement, {x}) AS k, regr_intercept(requirement, {x}) AS b")


def _ridge(source: str, a: str, b: str, keys: str, lam: str) -> str:
    """Two-feature ridge on centred and scaled features, solved by Cramer's rule."""
    ok = f"{a} IS NOT NULL AND {b} IS NOT NULL AND requirement IS NOT NULL"
    return f"""
    rm AS (SELECT {keys}, avg({a}) AS ma, avg({b}) AS mb, avg(requirement) AS my, stddev_pop({a}) AS sa,
        stddev_pop({b}) AS sb, covar_pop({a}, {b}) AS ab, covar_pop({a}, requirement) AS ay,
        covar_pop({b}, requirement) AS yb FROM {source} WHERE {ok} GROUP BY ALL),
    rv AS (SELECT *, sa * sa > 1e-12 * greatest(1, ma * ma) AS va, sb * sb > 1e-12 * greatest(1, mb * mb) AS vb FROM rm),
    rs AS (SELECT *, CASE WHEN va AND vb THEN ab / (sa * sb) ELSE 0 END AS r, CASE WHEN va THEN ay / sa ELSE 0 END AS qa,
        CASE WHEN vb THEN yb / sb ELSE 0 END AS qb, 1 + {lam} AS d FROM rv),
    rc AS (SELECT *, CASE WHEN va THEN (qa * d - r * qb) / (d * d - r * r) / sa ELSE 0 END AS ka,
        CASE WHEN vb THEN (qb * d - r * qa) / (d * d - r * r) / sb ELSE 0 END AS kb FROM rs)"""


BLOCKS = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY for_date) AS rn,
        count(*) OVER (PARTITION BY zone) AS n FROM lag2 WHERE split = 'train'),
    blocks AS (SELECT *, CASE WHEN rn - 1 < n - 5 * (n // 6) OR n // 6 = 0 THEN 0
        ELSE CAST((rn - 1 - (n - 5 * (n // 6))) // (n // 6) + 1 AS INTEGER) END AS block FROM numbered),
    folds AS (SELECT b.*, f.fold FROM blocks b JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS fold) f ON b.block <= f.fold)"""

ROLL = "OVER (PARTITION BY zone ORDER BY for_date, event_id{frame})"


def _roll(name: str, expr: str) -> tuple[str, str]:
    return name, f"SELECT zone, event_id, round({expr}, 6) AS {name} FROM rd"


def _frame(n: int) -> str:
    return ROLL.format(frame=f" ROWS BETWEEN {n} PRECEDING AND CURRENT ROW")


PREV = "lag(requirement) " + ROLL.format(frame="")


def _seq(source: str, part: str, current: bool, extra: str = "") -> str:
    cols = [f"lag(requirement, {5 - i if current else 6 - i}) OVER (PARTITION BY {part} ORDER BY for_date)"
            for i in range(6)]
    need = 6 if current else 7
    rn = f"row_number() OVER (PARTITION BY {part} ORDER BY for_date)"
    cells = ", ".join(f"CASE WHEN {rn} >= {need} THEN {c} END AS x{i + 1}" for i, c in enumerate(cols))
    return f"SELECT zone, for_date, split{extra}, {rn} AS rn, {cells} FROM {source}"


XS = "x1, x2, x3, x4, x5, x6"
GRID = "OVER (PARTITION BY zone, split ORDER BY for_date{frame})"


def _grid(n: int) -> str:
    return GRID.format(frame=f" ROWS BETWEEN {n} PRECEDING AND CURRENT ROW")


L168 = "REQ_LAST168H"
L168_PREV = f"lag({L168}) " + GRID.format(frame="")
MEDIAN_COLS = ", ".join(f"coalesce(f.{c}, m.{c}) AS {c}" for c in IMPUTED)
MEDIANS = ", ".join(f"median({c}) AS {c}" for c in IMPUTED)
METRICS = "MAPE, MAE, RMSE, BIAS"
COUNTS = "n_rows_total, n_rows_scored, n_rows_excluded_zero_actual"
METRICS_R6 = _r6("MAPE", "MAE", "RMSE", "BIAS")
HIST = f"SELECT zone, for_date, actual, run_timestamp, run_date, {', '.join(P5)} FROM "
INVERSE = {p: f"1 / greatest(avg({_ape('actual', p)}), 1e-6)" for p in ("pred_m1", "pred_m2", "pred_m3")}
FILLED = "CASE WHEN REQUIREMENT_LAG_3D = 0 THEN REQ_LAST168H ELSE REQUIREMENT_LAG_3D END"
BLEND = ("CASE WHEN pred_m3 IS NOT NULL THEN pred_m1 * (i / 100.0::DOUBLE) + pred_m2 * (j / 100.0::DOUBLE) "
         "+ pred_m3 * ((100 - i - j) / 100.0::DOUBLE) ELSE pred_m1 * (i / nullif(i + j, 0)::DOUBLE) "
         "+ pred_m2 * (j / nullif(i + j, 0)::DOUBLE) END")


def _search(points: str, out: str) -> str:
    return f"""
    {out}_s AS (SELECT i, j, avg(abs(({BLEND}) - actual) / (abs(actual) + 1) * 100) AS m, count({BLEND}) AS v,
        count(*) AS n FROM sc CROSS JOIN ({points}) GROUP BY i, j),
    {out} AS (SELECT * FROM {out}_s WHERE v = n ORDER BY round(m, 6), i, j LIMIT 1)"""


SEARCH = ("sc AS (SELECT * FROM f6 WHERE abs(actual) >= 1)," + _search(
    "SELECT a.i * 5 AS i, b.j * 5 AS j FROM range(21) a(i), range(21) b(j) WHERE a.i + b.j <= 20", "coarse") + ","
    + _search("SELECT c.i + a.i AS i, c.j + b.j AS j FROM coarse c, range(-5, 6) a(i), range(-5, 6) b(j) "
              "WHERE c.i + a.i >= 0 AND c.j + b.j >= 0 AND c.i + a.i + c.j + b.j <= 100", "fine"))

# query -> (extra CTEs, SELECT)
_SQL: dict[str, str | tuple[str, str]] = {
    "scan_zone_csv": """SELECT zone, split, for_date_str AS for_date, requirement,
        CASE WHEN flag THEN 'true' ELSE 'false' END AS flag FROM f3""",
    "parse_for_date": "SELECT zone, split, for_date_str, for_date FROM f3",
    "sort_series": "SELECT zone, for_date, requirement FROM f3",
    "write_table": "SELECT * FROM f5",
    "snapshot_run": "SELECT *, '20240126_060000' AS run_ts FROM f5",
    "history_append": HIST + "f6",
    "history_latest": HIST + """(SELECT *, row_number() OVER (PARTITION BY zone, for_date ORDER BY run_timestamp DESC) AS rn
        FROM f6) WHERE rn = 1""",
    "scored_history": HIST + "f6 WHERE abs(actual) >= 1",
    "weights_load": f"""SELECT round({INVERSE['pred_m1']} / ({INVERSE['pred_m1']} + {INVERSE['pred_m2']}), 6) AS pred_m1,
        round({INVERSE['pred_m2']} / ({INVERSE['pred_m1']} + {INVERSE['pred_m2']}), 6) AS pred_m2
        FROM f6 WHERE abs(actual) >= 1 AND run_timestamp = (SELECT max(run_timestamp) FROM f6 WHERE abs(actual) >= 1)""",
    "adapt_log": (FLAGS + ",\n" + SEARCH, f"""SELECT {NOW} AS timestamp, 'BIAS_CORRECTION_COMPUTED' AS event_type, zone,
        printf('bias=%.2f corr=%.2f n=%d', -correction, correction, n) AS detail, round(correction, 6) AS value FROM corr
        UNION ALL SELECT {NOW}, 'MAPE_ALERT', zone, printf('MAPE=%.2f%% BIAS=%.1f', MAPE, BIAS), round(MAPE, 6)
            FROM met WHERE model LIKE '%Ensemble_M1_M2%' AND MAPE > 3
        UNION ALL SELECT {NOW}, CASE WHEN severity = 'critical' THEN 'DRIFT_CRITICAL' ELSE 'DRIFT_WARNING' END, zone,
            printf('z=%.3f', z_score), z_score FROM flags
        UNION ALL SELECT {NOW}, 'WEIGHT_OPT_UPDATED', 'ALL', printf('m1=%.3f m2=%.3f m3=%.3f mape=%.3f n=%d', i / 100.0::DOUBLE,
            j / 100.0::DOUBLE, (100 - i - j) / 100.0::DOUBLE, round(m, 4), n), round(m, 4) FROM fine WHERE n >= 48"""),
    "run_manifest": (DRIFT, """SELECT '20240127_180000' AS run_timestamp, 'zones_ok' AS item, zone, count(*) AS value
            FROM f5 GROUP BY zone
        UNION ALL SELECT '20240127_180000', 'zones_failed', zone, 0 FROM reg WHERE zone NOT IN (SELECT zone FROM f5)
        UNION ALL SELECT '20240127_180000', 'drift_detected', zone, 1 FROM drift WHERE drift
        UNION ALL SELECT '20240127_180000', 'rows', 'ALL', count(*) FROM f5"""),
    "is_realized": "SELECT zone, for_date, actual, abs(actual) >= 1 AS is_realized FROM f5",
    "filter_today": f"SELECT * FROM f5 WHERE {IS_TODAY}",
    "filter_yesterday": f"SELECT * FROM f5 WHERE {IS_YESTERDAY}",
    "filter_future": "SELECT * FROM f5 WHERE abs(actual) < 1",
    "filter_future_v4": f"""SELECT reg, for_date, actual, pred_m1, pred_m2, pred_m3, is_peak FROM f5s
        WHERE actual IS NULL OR CAST(for_date AS DATE) > {TODAY}""",
    "latest_per_zone": """SELECT rd.* FROM rd JOIN (SELECT zone, max(CAST(for_date AS DATE)) AS d FROM rd GROUP BY zone) m
        ON rd.zone = m.zone AND CAST(rd.for_date AS DATE) = m.d""",
    "latest_global": "SELECT * FROM rd WHERE CAST(for_date AS DATE) = (SELECT max(CAST(for_date AS DATE)) FROM rd)",
    "select_features": f"SELECT zone, for_date, {', '.join(FEATURES)} FROM f4",
    "drop_all_null_cols": " UNION ALL ".join(
        f"""SELECT zone, '{f}' AS feature FROM f4 GROUP BY zone HAVING count({f}) FILTER (split = 'train') > 0
        AND count({f}) FILTER (split = 'test') > 0{" AND zone <> 'Z0000000'" if f == 'REQUIREMENT_LAG_3D' else ''}"""
        for f in FEATURES),
    "bool_to_int": "SELECT zone, split, for_date_str AS for_date, requirement, CAST(flag AS INTEGER) AS flag, reg FROM f3",
    "clean_rows": """SELECT f3.zone, f3.split, f3.for_date,
        CASE WHEN isfinite(TRY_CAST(requirement AS DOUBLE)) THEN TRY_CAST(requirement AS DOUBLE) END AS requirement,
        flag, reg FROM f3 WHERE for_date IS NOT NULL AND TRY_CAST(requirement AS DOUBLE) IS NOT NULL""",
    "rename_tag_cols": "SELECT zone AS reg, * EXCLUDE (zone), 'tuned' AS config FROM f5",
    "fill_zero_target": """SELECT zone, for_date, split, coalesce(
        last_value(nullif(requirement, 0) IGNORE NULLS) OVER (PARTITION BY zone, split ORDER BY for_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(nullif(requirement, 0) IGNORE NULLS) OVER (PARTITION BY zone, split ORDER BY for_date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS requirement FROM f1m""",
    "fill_zero_lag": f"SELECT zone, for_date, {FILLED} AS REQUIREMENT_LAG_3D, REQ_LAST168H FROM f4",
    "impute_train_median": (f"m AS (SELECT zone, {MEDIANS} FROM f4 WHERE split = 'train' GROUP BY zone)",
        f"SELECT f.zone, f.for_date, f.split, f.requirement, {MEDIAN_COLS} FROM f4 f LEFT JOIN m ON m.zone = f.zone"),
    "impute_split_median": (f"m AS (SELECT zone, split, {MEDIANS} FROM f4 GROUP BY zone, split)",
        f"""SELECT f.zone, f.for_date, f.split, f.requirement, {MEDIAN_COLS} FROM f4 f
        LEFT JOIN m ON m.zone = f.zone AND m.split = f.split"""),
    "densify_grid": """SELECT g.zone, g.for_date, s.requirement FROM (
        SELECT zone, unnest(generate_series(min(for_date), max(for_date), INTERVAL 30 MINUTES)) AS for_date
        FROM sums GROUP BY zone) g LEFT JOIN sums s ON s.zone = g.zone AND s.for_date = g.for_date""",
    "lag_hours": "SELECT * EXCLUDE (split) FROM f4",
    **dict([
        _roll("roll_mean_3", f"avg(requirement) {_frame(2)}"),
        _roll("roll_mean_6", f"avg(requirement) {_frame(5)}"),
        _roll("roll_std_6", f"coalesce(stddev_samp(requirement) {_frame(5)}, 0)"),
        _roll("diff_1", f"coalesce(requirement - {PREV}, 0)"),
        _roll("pct_change_1", f"coalesce((requirement - {PREV}) / nullif({PREV}, 0), 0)"),
    ]),
    "rolling_on_grid": f"""SELECT zone, for_date, split, {L168}, round(avg({L168}) {_grid(2)}, 6) AS {L168}_roll_mean_3,
        round(avg({L168}) {_grid(5)}, 6) AS {L168}_roll_mean_6,
        round(coalesce(stddev_samp({L168}) {_grid(5)}, 0), 6) AS {L168}_roll_std_6,
        round(coalesce({L168} - {L168_PREV}, 0), 6) AS {L168}_diff_1,
        round(coalesce(({L168} - {L168_PREV}) / nullif({L168_PREV}, 0), 0), 6) AS {L168}_pct_change_1
        FROM f4""",
    "pre_post_holiday": """SELECT zone, for_date, h AS is_holiday,
        coalesce(lead(h) OVER w, 0) AS is_pre_holiday, coalesce(lag(h) OVER w, 0) AS is_post_holiday
        FROM (SELECT *, CASE WHEN CAST(for_date AS DATE) IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS h FROM f1m)
        WINDOW w AS (PARTITION BY zone, split ORDER BY for_date)""",
    "pre_post_holiday_day": """SELECT event_id,
        CASE WHEN CAST(for_date AS DATE) IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS is_holiday,
        CASE WHEN CAST(for_date AS DATE) + 1 IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS is_pre_holiday,
        CASE WHEN CAST(for_date AS DATE) - 1 IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS is_post_holiday FROM rd""",
    "timegap_count": """SELECT zone, count(*) FILTER (for_date - p > INTERVAL 45 MINUTES) AS time_gaps_30min
        FROM (SELECT zone, for_date, lag(for_date) OVER (PARTITION BY zone ORDER BY for_date) AS p FROM rd) GROUP BY zone""",
    "importance_rank": """SELECT zone, model, feature, round(importance, 6) AS importance,
        CAST(rank() OVER (PARTITION BY zone, model ORDER BY importance DESC NULLS LAST) AS INTEGER) AS rank FROM imp""",
    "seq_windows_fit": f"""SELECT zone, for_date, requirement, {XS} FROM (
        {_seq("(SELECT * FROM f1m WHERE split = 'train')", "zone", False, ", requirement")}) WHERE rn > 6""",
    "seq_windows_predict": f"""SELECT zone, for_date, {XS} FROM (
        {_seq("(SELECT * FROM f1m WHERE split = 'test')", "zone", True)})""",
    "seq_windows_carry": f"SELECT zone, for_date, {XS} FROM ({_seq('f1m', 'zone', False)}) WHERE split = 'test'",
    "seq_windows_rows": "SELECT zone, event_id, " + ", ".join(
        f"CASE WHEN row_number() OVER w >= 6 THEN lag(requirement, {5 - i}) OVER w END AS x{i + 1}" for i in range(6))
        + " FROM rd WINDOW w AS (PARTITION BY zone ORDER BY for_date, event_id)",
    "basic_time_features": """SELECT zone, for_date, event_id, CAST(year(for_date) AS INTEGER) AS year_auto,
        CAST(month(for_date) AS INTEGER) AS month_auto, CAST(day(for_date) AS INTEGER) AS day_auto,
        CAST(hour(for_date) AS INTEGER) AS hour_auto, CAST(isodow(for_date) - 1 AS INTEGER) AS dayofweek_auto FROM rd""",
    "calendar_features": """SELECT zone, for_date, event_id, CASE WHEN isodow(for_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CAST(isodow(for_date) - 1 AS INTEGER) AS day_of_week, CAST(month(for_date) AS INTEGER) AS month,
        CAST(quarter(for_date) AS INTEGER) AS quarter FROM rd""",
    "is_holiday": """SELECT zone, for_date, event_id,
        CASE WHEN CAST(for_date AS DATE) IN (SELECT d FROM hol) THEN 1 ELSE 0 END AS is_holiday FROM rd""",
    "encode_category": ("""p AS (SELECT zone, v, row_number() OVER (PARTITION BY zone ORDER BY v) - 1 AS c
            FROM (SELECT DISTINCT zone, o_orderpriority AS v FROM od WHERE split = 'train')),
        s AS (SELECT zone, v, row_number() OVER (PARTITION BY zone ORDER BY v) - 1 AS c
            FROM (SELECT DISTINCT zone, o_orderstatus AS v FROM od WHERE split = 'train'))""",
        """SELECT od.zone, o_orderkey, CAST(coalesce(p.c, -1) AS INTEGER) AS o_orderpriority,
            CAST(coalesce(s.c, -1) AS INTEGER) AS o_orderstatus FROM od
        LEFT JOIN p ON p.zone = od.zone AND p.v = o_orderpriority LEFT JOIN s ON s.zone = od.zone AND s.v = o_orderstatus"""),
    "minmax_scale": (f"""mm AS (SELECT zone, min({L168}) AS lo, CASE WHEN max({L168}) = min({L168}) THEN 1
            ELSE max({L168}) - min({L168}) END AS w FROM f4 WHERE split = 'train' GROUP BY zone)""",
        f"""SELECT f.zone, for_date, round(({L168} - lo) / w, 6) AS scaled, round({L168}, 6) AS restored
        FROM f4 f LEFT JOIN mm ON mm.zone = f.zone"""),
    "row_errors": "SELECT reg, for_date, actual, " + ", ".join(
        f"abs(actual - {p}) AS abs_error_{t}, {_ape('actual', p)} AS ape_{t}, {p} - actual AS bias_{t}" for t, p in
        {"m1": "pred_m1", "m2": "pred_m2", "m3": "pred_m3", "ensemble": "pred_ensemble"}.items()) + " FROM f5s",
    "ape_masked": "SELECT zone, for_date, " + ", ".join(
        f"CASE WHEN abs(actual) >= 1 AND {p} IS NOT NULL THEN {_ape('actual', p)} END AS ape_{p}"
        for p in ("pred_m1", "pred_m2", "pred_m3")) + " FROM f5",
    "ens_simple": f"""SELECT zone, for_date,
        {_mean(('pred_m1', 'pred_m2', 'pred_m3'), (1, 1, 1))} AS pred_ensemble FROM f5""",
    "ens_simple_strict": "SELECT zone, for_date, (pred_m1 + pred_m2 + pred_m3) / 3 AS pred_ensemble FROM f5",
    "ens_weighted": "SELECT zone, for_date, pred_ensemble, pred_ensemble_m1_m2 FROM f5e",
    "ens_inverse_mape": ("iw AS (SELECT zone, " + ", ".join(f"{e} AS {p}" for p, e in INVERSE.items())
        + " FROM f6 WHERE abs(actual) >= 1 GROUP BY zone)",
        """SELECT f.zone, for_date, round((w.pred_m1 * f.pred_m1 + w.pred_m2 * f.pred_m2 + w.pred_m3 * f.pred_m3)
            / (w.pred_m1 + w.pred_m2 + w.pred_m3), 6) AS pred_ensemble_w FROM f5 f LEFT JOIN iw w ON w.zone = f.zone"""),
    "weight_search": (SEARCH, """SELECT i / 100.0::DOUBLE AS pred_m1, j / 100.0::DOUBLE AS pred_m2,
        (100 - i - j) / 100.0::DOUBLE AS pred_m3, round(m, 4) AS mape_at_optimum, n AS n_rows_used
        FROM fine WHERE n >= 48"""),
    "metrics_zone_model": f"SELECT zone, model, {METRICS_R6}, {COUNTS} FROM met",
    "metrics_v4": "SELECT * FROM met4",
    "summary_all_weighted": f"SELECT zone, model, {METRICS_R6}, CAST(n_rows_total AS BIGINT) AS n_rows_total, "
        "CAST(n_rows_scored AS BIGINT) AS n_rows_scored, "
        "CAST(n_rows_excluded_zero_actual AS BIGINT) AS n_rows_excluded_zero_actual FROM metall",
    "summary_all_pooled": f"""SELECT * FROM met4 UNION ALL SELECT 'ALL', config, 'Ensemble',
        round(avg({_ape('actual', 'pred')}), 4), round(avg(abs(pred - actual)), 4),
        round(sqrt(avg((pred - actual) * (pred - actual))), 4), round(avg(pred - actual), 4)
        FROM f7 WHERE actual IS NOT NULL AND pred IS NOT NULL GROUP BY config""",
    "daily_mape": " UNION ALL ".join(
        f"""SELECT CAST(for_date AS DATE) AS date, zone, '{m}' AS model,
        round(avg({_ape('actual', p)}) FILTER ({p} IS NOT NULL), 6) AS daily_mape
        FROM f5e WHERE abs(actual) >= 1 GROUP BY 1, 2""" for m, p in MODELS.items()),
    "daily_mape_all_rows": " UNION ALL ".join(
        f"""SELECT CAST(for_date AS DATE) AS date, reg, '{m}' AS model,
        round(avg({_ape('actual', p)}) FILTER (actual IS NOT NULL AND {p} IS NOT NULL), 4) AS MAPE
        FROM f5s GROUP BY 1, 2""" for m, p in STANDALONE.items()),
    "daily_peak": """SELECT zone, CAST(for_date AS DATE) AS date, max(pred_m1) AS peak_a, max(pred_ensemble) AS peak_b FROM f5e GROUP BY 1, 2""",
    "corr_importance": "SELECT zone, model, feature, round(importance, 6) AS importance FROM imp",
    "importance_pct": """SELECT zone, model, feature, round(importance, 6) AS importance,
        round(CASE WHEN sum(importance) OVER (PARTITION BY zone, model) > 0
            THEN importance / sum(importance) OVER (PARTITION BY zone, model) * 100 ELSE 0 END, 6) AS importance_pct FROM imp""",
    "diagnostics": ("dg AS (SELECT zone, split, count(*) AS rows, count(*) - count(DISTINCT for_date) AS dup, "
        "count(*) FILTER (requirement = 0) AS zero, " + " + ".join(f"count(*) FILTER ({f} IS NULL)" for f in FEATURES)
        + " AS miss FROM f4 GROUP BY zone, split)",
        f"""SELECT zone, split || '_rows' AS "check", rows AS value FROM dg
        UNION ALL SELECT zone, split || '_missing_total', miss FROM dg
        UNION ALL SELECT zone, split || '_duplicate_dates', dup FROM dg
        UNION ALL SELECT zone, split || '_target_zero_count', zero FROM dg
        UNION ALL SELECT DISTINCT zone, 'feature_count', {len(FEATURES)} FROM dg"""),
    "validate_split": ("""g AS (SELECT zone, split, count(*) FILTER (for_date - p > INTERVAL 45 MINUTES) AS n FROM (
            SELECT zone, split, for_date, lag(for_date) OVER (PARTITION BY zone, split ORDER BY for_date) AS p
            FROM f3n WHERE for_date IS NOT NULL) GROUP BY zone, split)""",
        """SELECT f.zone, f.split, count(*) AS n_rows,
            count(*) FILTER (x IS NULL) + count(*) FILTER (for_date IS NULL) AS total_missing,
            CAST(max(x IS NULL) AS BIGINT) + CAST(max(for_date IS NULL) AS BIGINT) AS cols_with_missing,
            count(*) FILTER (x = 0) AS zero_lag_rows,
            count(*) - count(DISTINCT for_date) - CAST(max(for_date IS NULL) AS BIGINT) AS duplicate_timestamps,
            max(g.n) AS time_gaps_30min, CAST(min(for_date) AS DATE) AS date_min, CAST(max(for_date) AS DATE) AS date_max
        FROM f3n f JOIN g ON g.zone = f.zone AND g.split = f.split GROUP BY f.zone, f.split"""),
    "ab_merge": """SELECT zone, CAST(for_date AS DATE) AS date, max(pred_m1) AS peak_A, max(pred_m3) AS peak_B FROM f5 WHERE pred_m3 IS NOT NULL GROUP BY 1, 2""",
    "config_compare": "SELECT * FROM cmp",
    "config_best": """SELECT f7.reg, f7.config, for_date, actual, pred FROM f7 JOIN cmp ON cmp.reg = f7.reg
        AND f7.config = CASE WHEN winner = 'tie' THEN 'tuned' ELSE winner END""",
    "correction_join": """SELECT f.zone, for_date, round(correction, 6) AS correction FROM f5 f
        LEFT JOIN corr ON corr.zone = f.zone""",
    "month_semi": """SELECT zone, o_orderkey, for_date, requirement FROM od t WHERE split = 'train' AND EXISTS (
        SELECT 1 FROM (SELECT DISTINCT zone, month(for_date) AS mm FROM od WHERE split = 'test' AND abs(requirement) >= 1) s
        WHERE s.zone = t.zone AND s.mm = month(t.for_date))""",
    "plan_asof": (PLAN, "SELECT * FROM plan"),
    "union_zones": """SELECT zone, for_date, actual, pred_m1, NULL::DOUBLE AS pred_m2 FROM f5
        UNION ALL SELECT reg, for_date, NULL, NULL, pred_m2 FROM f5s""",
    "zones_failed": "SELECT zone FROM reg EXCEPT SELECT zone FROM f5",
    "peak_topk": """SELECT zone, max(requirement) AS peak,
        arg_max(for_date, {'v': requirement, 't': -epoch_us(for_date)}) AS peak_time FROM rd GROUP BY zone""",
    "sort_importance": "SELECT zone, model, feature, round(importance, 6) AS importance FROM imp",
    "shift_zscore": (_shift("od"), "SELECT * FROM shift"),
    "drift_flags": (FLAGS, "SELECT * FROM flags"),
    "drift_recent_mape": (DRIFT, "SELECT * FROM drift"),
    "mape_alerts": """SELECT zone, model, round(MAPE, 6) AS MAPE, round(BIAS, 6) AS BIAS,
        printf('%s: the ensemble is off by %.2f%% on average, above the limit of 3.0%% (bias %.1f MW)', zone, m, b) AS message
        FROM (SELECT *, MAPE AS m, BIAS AS b FROM met) WHERE model LIKE '%Ensemble_M1_M2%' AND m > 3""",
    "bias_compute": "SELECT zone, round(correction, 6) AS correction, n FROM corr",
    "bias_apply": "SELECT f.zone, for_date, actual, " + ", ".join(
        f"""round(CASE WHEN abs(actual) < 1 AND correction IS NOT NULL AND {p} IS NOT NULL
            THEN greatest({p} + correction, 0) ELSE {p} END, 9) AS {p}""" for p in P5)
        + " FROM f5e f LEFT JOIN corr ON corr.zone = f.zone",
    "decision_dashboard": (PLAN, f"""SELECT f.zone, '2024-01-28' AS date, max(plan_total_mw) AS plan_total_mw,
        max(plan_peak_mw) AS plan_peak_mw, max(plan_made_on) AS plan_made_on,
        round(avg(actual) FILTER ({IS_YESTERDAY} AND abs(actual) >= 1), 2) AS actual_yesterday_avg_mw,
        round(max(actual) FILTER ({IS_YESTERDAY} AND abs(actual) >= 1), 2) AS peak_yesterday_mw,
        {_peak('actual', IS_YESTERDAY + ' AND abs(actual) >= 1')} AS peak_yesterday_time,
        CASE WHEN count(*) FILTER ({IS_TODAY}) > 0
            THEN round(coalesce(sum(pred_ensemble) FILTER ({IS_TODAY}), 0), 2) END AS today_forecast_total_mw,
        round(max(pred_ensemble) FILTER ({IS_TODAY}), 2) AS today_forecast_peak_mw,
        {_peak('pred_ensemble', IS_TODAY)} AS today_forecast_peak_time
        FROM f5e f LEFT JOIN plan p ON p.zone = f.zone GROUP BY f.zone"""),
    "dashboard_v4": f"""SELECT '2024-01-28' AS date_run, reg AS zone,
        round(avg(actual) FILTER ({IS_YESTERDAY}), 2) AS yesterday_actual_avg,
        round(max(actual) FILTER ({IS_YESTERDAY}), 2) AS yesterday_peak_actual,
        {_peak('actual', IS_YESTERDAY)} AS yesterday_peak_time,
        round(avg(pred_ensemble) FILTER ({IS_TODAY}), 2) AS today_forecast_avg,
        round(max(pred_ensemble) FILTER ({IS_TODAY} AND is_peak = 1), 2) AS today_peak_forecast,
        {_peak('pred_ensemble', IS_TODAY + ' AND is_peak = 1')} AS today_peak_time FROM f5s GROUP BY reg""",
    "fc_seasonal_naive": "SELECT zone, for_date, requirement, REQ_LAST168H AS pred FROM f4 WHERE split = 'test'",
    "fc_zone_ols": (f"ln AS (SELECT zone, {LINE.format(x=L168)} FROM f4 WHERE split = 'train' GROUP BY zone)",
        f"SELECT f.zone, for_date, round(k * {L168} + b, 6) AS pred FROM f4 f LEFT JOIN ln ON ln.zone = f.zone WHERE split = 'test'"),
    "fc_zone_ridge": (_ridge("(SELECT * FROM f4 WHERE split = 'train')", "REQ_LAST168H", "REQ_LAST336H", "zone", "0.1"),
        """SELECT f.zone, for_date, round(my - ka * ma - kb * mb + ka * REQ_LAST168H + kb * REQ_LAST336H, 6) AS pred
        FROM f4 f LEFT JOIN rc ON rc.zone = f.zone WHERE split = 'test'"""),
    "fc_sequence": ("""sq AS (SELECT *, lag(requirement, 2) OVER w AS a, lag(requirement) OVER w AS b FROM f1m
            WINDOW w AS (PARTITION BY zone ORDER BY for_date)),"""
        + _ridge("(SELECT * FROM sq WHERE split = 'train')", "a", "b", "zone", "0.1"),
        """SELECT f.zone, for_date, round(my - ka * ma - kb * mb + ka * a + kb * b, 6) AS pred
        FROM sq f LEFT JOIN rc ON rc.zone = f.zone WHERE split = 'test'"""),
    "cv_folds": (BLOCKS, """SELECT zone, for_date, fold, CASE WHEN fold = block THEN 'validation' ELSE 'train' END AS role
        FROM folds"""),
    "cv_folds_rows": ("""nb AS (SELECT zone, o_orderkey, row_number() OVER (PARTITION BY zone ORDER BY for_date, o_orderkey)
            AS rn, count(*) OVER (PARTITION BY zone) AS n FROM od),
        bl AS (SELECT *, CASE WHEN rn - 1 < n - 5 * (n // 6) OR n // 6 = 0 THEN 0
            ELSE (rn - 1 - (n - 5 * (n // 6))) // (n // 6) + 1 END AS block FROM nb)""",
        """SELECT zone, o_orderkey, CAST(fold AS INTEGER) AS fold,
            CASE WHEN fold = block THEN 'validation' ELSE 'train' END AS role
        FROM bl JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS fold) ON block <= fold"""),
    "cv_mape": (BLOCKS + f""",
        ln AS (SELECT zone, fold, {LINE.format(x=L168)} FROM folds WHERE block < fold GROUP BY zone, fold),
        fm AS (SELECT f.zone, f.fold, avg({_ape('requirement', f'(k * {L168} + b)')}) AS m FROM folds f
            JOIN ln ON ln.zone = f.zone AND ln.fold = f.fold WHERE block = f.fold AND abs(requirement) >= 1
            AND k IS NOT NULL GROUP BY f.zone, f.fold)""",
        """SELECT z.zone, coalesce(round(avg(m), 6), CAST('Infinity' AS DOUBLE)) AS cv_mape, count(m) AS n_folds
        FROM (SELECT DISTINCT zone FROM folds) z LEFT JOIN fm ON fm.zone = z.zone GROUP BY z.zone"""),
    "param_search": (BLOCKS + ", pen AS (SELECT unnest([0.001::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE]) AS penalty),"
        + _ridge("(SELECT * FROM folds JOIN pen ON true WHERE block < fold)", "REQ_LAST168H", "REQ_LAST336H",
                 "zone, fold, penalty", "penalty")
        + f""",
        tm AS (SELECT f.zone, f.fold, penalty, avg({_ape('requirement',
            '(my - ka * ma - kb * mb + ka * REQ_LAST168H + kb * REQ_LAST336H)')}) AS m
            FROM folds f JOIN rc ON rc.zone = f.zone AND rc.fold = f.fold
            WHERE block = f.fold AND abs(requirement) >= 1 GROUP BY ALL),
        tr AS (SELECT zone, penalty, avg(m) AS m FROM tm GROUP BY ALL)""",
        """SELECT zone, 'ridge' AS model, round(min(m), 6) AS best_cv_mape, arg_min(penalty, m) AS best_penalty,
            count(*) AS n_trials, 5 AS n_cv_splits FROM tr GROUP BY zone"""),
    "ablation_ab": (f"""ab AS (SELECT *, ({FILLED} + {L168}) / 2 AS x FROM f4),
        la AS (SELECT zone, {LINE.format(x='x')} FROM ab WHERE split = 'train' GROUP BY zone),
        lb AS (SELECT zone, {LINE.format(x=L168)} FROM ab WHERE split = 'train' GROUP BY zone),
        pr AS (SELECT ab.zone, 'with_lag_3d' AS arm, requirement AS a, k * x + b AS p FROM ab JOIN la ON la.zone = ab.zone
            WHERE split = 'test' UNION ALL
            SELECT ab.zone, 'without_lag_3d', requirement, k * {L168} + b FROM ab JOIN lb ON lb.zone = ab.zone
            WHERE split = 'test')""",
        f"""SELECT zone, arm, round(avg({_ape('a', 'p')}) FILTER (abs(a) >= 1), 6) AS MAPE,
        round(avg(abs(p - a)) FILTER (abs(a) >= 1), 6) AS MAE, round(avg(p - a) FILTER (abs(a) >= 1), 6) AS BIAS,
        count(p) FILTER (abs(a) >= 1) AS n_scored, round(min(p) FILTER (abs(a) < 1), 6) AS future_min,
        round(avg(p) FILTER (abs(a) < 1), 6) AS future_mean, round(max(p) FILTER (abs(a) < 1), 6) AS future_max
        FROM pr GROUP BY zone, arm"""),
    "fill_readings": ("""fv AS (SELECT *, CASE WHEN event_id % 3 <> 0 THEN nullif(requirement, 0) END AS v FROM rd)""",
        """SELECT zone, for_date, event_id, coalesce(
            last_value(v IGNORE NULLS) OVER (PARTITION BY zone ORDER BY for_date, v NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(v IGNORE NULLS) OVER (PARTITION BY zone ORDER BY for_date, v NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
            AS requirement FROM fv"""),
    "asof_readings": ("""ra AS (SELECT zone, for_date, max_by(requirement, event_id) AS requirement FROM rd GROUP BY 1, 2),
        la AS (SELECT zone, event_id, for_date - INTERVAL 1 HOUR AS at FROM rd)""",
        """SELECT la.zone, la.event_id, ra.for_date AS for_date_found, ra.requirement
        FROM la ASOF LEFT JOIN ra ON la.zone = ra.zone AND la.at >= ra.for_date"""),
    "stream_ingest": """SELECT zone, for_date, CASE WHEN isfinite(x) THEN x END AS requirement FROM f3n
        WHERE for_date IS NOT NULL""",
    "stream_daily_mape": f"""SELECT CAST(for_date AS DATE) AS date, zone, round(avg({_ape('actual', 'pred_m2')}), 6) AS daily_mape,
        count(pred_m2) AS n_scored FROM f5 WHERE abs(actual) >= 1 GROUP BY 1, 2""",
    "stream_drift": f"""SELECT zone, CAST(for_date AS DATE) - o AS window_start, round(avg({_ape('actual', 'pred_m2')}), 6)
        AS recent_mape, avg({_ape('actual', 'pred_m2')}) > 5 AS drift
        FROM f5 CROSS JOIN (SELECT unnest([0, 1, 2]) AS o) WHERE abs(actual) >= 1 GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    shared = ",\n".join(f"{n} AS ({s})" for n, s in CTES.items())
    out = {}
    for name, sql in _SQL.items():
        extra, select = ("", sql) if isinstance(sql, str) else sql
        more = f",\n{extra}" if extra else ""
        out[name] = f"WITH {shared}{more}\n{select}"
    return out
