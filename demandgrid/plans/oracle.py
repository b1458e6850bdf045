"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``lineitem orders customer nation region events ...`` are views over
the same Parquet files. Every computed column is aliased to the Spark name;
doubles are rounded to 6 places on both sides, counts are BIGINT, small
integer features INTEGER.
"""

from __future__ import annotations

from demandgrid import constants as C

ORACLE: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


def _date(d) -> str:
    return f"DATE '{d.isoformat()}'"


# Rules and limits of the data contract, stated here on their own (fixed values).
SHIPPED = "('F', 'O')"
REQUEST_DAYS = 90                       # both end dates included
ALPHA_LOW, ALPHA_HIGH = -2.0, 2.0
RATIO_LOW, RATIO_HIGH = 0.5, 10.0
SERVER_ALPHA, SERVER_RATIO = 0.65, 3.0


def panel_ctes(grain: str = "nation", name: str = "panel") -> str:
    """CTEs ending in ``{name}(shipment_date, entity, n_shipments)``: every entity
    gets the series of days between the first and the last shipment of all, and
    the count of its shipments on each."""
    place = {"nation": ("n_name", "nation"), "region": ("r_name", "nation JOIN region ON r_regionkey = n_regionkey")}[grain]
    return f"""
{name}_buyers AS (
  SELECT o_orderkey AS k, {place[0]} AS who
  FROM {place[1]} JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
  WHERE o_orderstatus IN {SHIPPED}
),
{name}_found AS (
  SELECT who, l_shipdate::DATE AS day, count(*) AS c
  FROM lineitem JOIN {name}_buyers ON k = l_orderkey WHERE l_shipdate IS NOT NULL GROUP BY who, day
),
{name}_days AS (
  SELECT who, unnest(generate_series((SELECT min(day) FROM {name}_found), (SELECT max(day) FROM {name}_found), INTERVAL 1 DAY))::DATE AS day
  FROM (SELECT DISTINCT who FROM {name}_found)
),
{name} AS (
  SELECT day AS shipment_date, who AS entity, coalesce(c, 0)::BIGINT AS n_shipments
  FROM {name}_days LEFT JOIN {name}_found USING (who, day)
)"""


@oracle("panel_nation")
@oracle("panel_by_batches")
def _():
    return f"WITH {panel_ctes('nation')} SELECT * FROM panel"


@oracle("panel_region")
def _():
    return f"WITH {panel_ctes('region')} SELECT * FROM panel"


@oracle("panel_summary")
def _():
    return f"""WITH {panel_ctes('nation')}
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT shipment_date) AS n_days,
       COUNT(DISTINCT entity) AS n_entities, MIN(shipment_date) AS first_date,
       MAX(shipment_date) AS last_date, CAST(SUM(n_shipments) AS BIGINT) AS total_shipments,
       CAST(SUM(CASE WHEN n_shipments = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_days
FROM panel"""


# ---------------------------------------------------------------------------
# Calendar pieces in SQL
# ---------------------------------------------------------------------------
def holiday_ctes(src: str = "panel") -> str:
    """CTEs ``hol_years``, ``easter``, ``holidays(hd)`` for min..max year of src."""
    parts = [f"SELECT make_date(y, {m}, {d}) AS hd FROM hol_years" for m, d in C.FIXED_HOLIDAYS]
    parts += [f"SELECT make_date(y, {m}, {d}) AS hd FROM hol_years WHERE y >= {first}"
              for first, m, d in C.LATER_FIXED_HOLIDAYS]
    parts += [f"SELECT CAST(e + INTERVAL ({off}) DAY AS DATE) AS hd FROM easter" for off in C.EASTER_OFFSETS]
    union = "\n    UNION ALL ".join(parts)
    return f"""
hol_years AS (
  SELECT CAST(unnest(range(MIN(year(shipment_date)), MAX(year(shipment_date)) + 1)) AS INTEGER) AS y FROM {src}
),
easter AS (
  -- Gauss' rule for 1900..2099: days after March 22 from the moon (d) and the weekday (e), two exceptions
  SELECT y, make_date(y, 3, 22) + CAST(d + e - CASE WHEN e = 6 AND (d = 29 OR (d = 28 AND y % 19 > 10)) THEN 7 ELSE 0 END AS INTEGER) AS e
  FROM (SELECT y, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 AS e
        FROM (SELECT y, (19 * (y % 19) + 24) % 30 AS d FROM hol_years))
),
holidays AS (
  SELECT DISTINCT hd FROM (
    {union}) WHERE hd IS NOT NULL
)"""


def black_friday_sql(y: str) -> str:
    nov1 = f"make_date({y}, 11, 1)"
    return f"CAST({nov1} + INTERVAL (((4 - isodow({nov1}) + 7) % 7) + 22) DAY AS DATE)"


def day_flags_sql(d: str = "p.shipment_date", hol: str = "(h.hd IS NOT NULL)") -> dict[str, str]:
    dow = f"(isodow({d}) - 1)"
    return {
        "is_holiday": f"CAST({hol} AS INTEGER)",
        "is_business_day": f"CAST({dow} < 5 AND NOT {hol} AS INTEGER)",
        "is_saturday": f"CAST({dow} = 5 AS INTEGER)",
        "is_sunday": f"CAST({dow} = 6 AS INTEGER)",
        "is_operational": f"CAST(({dow} < 5 AND NOT {hol}) OR {dow} = 5 AS INTEGER)",
        "day_type": f"CASE WHEN {hol} THEN 'holiday' WHEN {dow} = 6 THEN 'sunday' "
                    f"WHEN {dow} = 5 THEN 'saturday' ELSE 'business_day' END",
    }


def event_ctes(src: str = "panel") -> str:
    """CTE ``event_days(shipment_date, days_to_black_friday, days_to_dia_dos_namorados)``."""
    return f"""
ev_years AS (SELECT DISTINCT CAST(year(shipment_date) AS INTEGER) AS y FROM {src}),
ev_dates AS (SELECT y, {black_friday_sql('y')} AS bf, make_date(y, 6, 12) AS vd FROM ev_years),
ev_days AS (SELECT DISTINCT shipment_date FROM {src}),
ev_bf AS (
  SELECT shipment_date, delta FROM (
    SELECT d.shipment_date, date_diff('day', e.bf, d.shipment_date) AS delta,
           row_number() OVER (PARTITION BY d.shipment_date
                              ORDER BY abs(date_diff('day', e.bf, d.shipment_date)), e.y) AS rn
    FROM ev_days d CROSS JOIN ev_dates e) WHERE rn = 1
),
ev_vd AS (
  SELECT shipment_date, delta FROM (
    SELECT d.shipment_date, date_diff('day', e.vd, d.shipment_date) AS delta,
           row_number() OVER (PARTITION BY d.shipment_date
                              ORDER BY abs(date_diff('day', e.vd, d.shipment_date)), e.y) AS rn
    FROM ev_days d CROSS JOIN ev_dates e) WHERE rn = 1
),
event_days AS (
  SELECT b.shipment_date,
         CAST(b.delta AS INTEGER) AS days_to_black_friday,
         CAST(b.delta BETWEEN -7 AND 7 AS INTEGER) AS is_black_friday_window,
         CAST(b.delta BETWEEN 1 AND 3 AS INTEGER) AS is_post_black_friday_peak,
         CAST(v.delta AS INTEGER) AS days_to_dia_dos_namorados,
         CAST(v.delta BETWEEN -7 AND 7 AS INTEGER) AS is_dia_dos_namorados_window,
         CAST(v.delta BETWEEN 1 AND 3 AS INTEGER) AS is_post_dia_dos_namorados_peak
  FROM ev_bf b JOIN ev_vd v USING (shipment_date)
)"""


EVENT_COLS = ("days_to_black_friday", "is_black_friday_window", "is_post_black_friday_peak",
              "days_to_dia_dos_namorados", "is_dia_dos_namorados_window",
              "is_post_dia_dos_namorados_peak")

def sql_feature_select() -> str:
    """Lags, trailing means and the deviation of each of the last seven values
    from the mean of those before it, all from a list of the previous 28."""
    lags = ", ".join(f"back[-{k}]::INTEGER AS lag_{k}" for k in (1, 7, 14, 28))
    means = ", ".join(f"round(list_avg(list_slice(back, greatest(len(back) - {w - 1}, 1), len(back))), 6) AS rolling_mean_{w}" for w in (7, 14, 28))
    return f"""SELECT shipment_date, entity, n_shipments, {lags}, {means},
  CASE WHEN len(week) >= 2 THEN round(sqrt(list_avg(list_transform(range(2, len(week) + 1),
       lambda k: (week[k] - list_avg(week[1:k - 1])) ** 2))), 6) END AS rolling_dev_7
FROM (SELECT *, list_slice(back, greatest(len(back) - 6, 1), len(back)) AS week
      FROM (SELECT *, coalesce(list(n_shipments) OVER (PARTITION BY entity ORDER BY shipment_date
                                                       ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), []) AS back FROM panel))"""


@oracle("features_sql_table")
def _():
    return f"WITH {panel_ctes()} {sql_feature_select()}"


@oracle("features_sparse")
def _():
    return f"WITH {panel_ctes()} SELECT * FROM ({sql_feature_select()}) WHERE n_shipments > 0"


@oracle("feature_coverage")
def _():
    return f"""WITH {panel_ctes()}, f AS ({sql_feature_select()})
SELECT COUNT(*) AS total_rows, COUNT(lag_1) AS n_lag_1, COUNT(lag_28) AS n_lag_28,
       COUNT(rolling_mean_7) AS n_rolling_mean_7, COUNT(rolling_dev_7) AS n_rolling_dev_7 FROM f"""


@oracle("features_rolling")
def _():
    cols = []
    for w in (7, 28):
        frame = f"(PARTITION BY entity ORDER BY shipment_date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            cols.append(f"round(CASE WHEN count(n_shipments) OVER {frame} >= 3 THEN "
                        f"CAST({fn}(n_shipments) OVER {frame} AS DOUBLE) END, 6) AS rolling_{stat}_{w}")
    return f"WITH {panel_ctes()} SELECT shipment_date, entity, n_shipments, {', '.join(cols)} FROM panel"


@oracle("features_calendar")
def _():
    d = "shipment_date"
    return f"""WITH {panel_ctes()}
SELECT shipment_date, entity, n_shipments,
  CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week, CAST(day({d}) AS INTEGER) AS day_of_month,
  CAST(dayofyear({d}) AS INTEGER) AS day_of_year, CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
  CAST(month({d}) AS INTEGER) AS month, CAST(quarter({d}) AS INTEGER) AS quarter,
  CAST(year({d}) AS INTEGER) AS year, CAST(isodow({d}) >= 6 AS INTEGER) AS is_weekend,
  CAST(day({d}) = 1 AS INTEGER) AS is_month_start, CAST({d} = last_day({d}) AS INTEGER) AS is_month_end
FROM panel"""


@oracle("features_holidays")
def _():
    flags = ", ".join(f"{v} AS {k}" for k, v in day_flags_sql().items())
    return f"""WITH {panel_ctes()}, {holiday_ctes()}
SELECT p.shipment_date, p.entity, p.n_shipments, {flags}
FROM panel p LEFT JOIN holidays h ON h.hd = p.shipment_date"""


@oracle("features_events")
def _():
    return f"""WITH {panel_ctes()}, {event_ctes()}
SELECT p.*, {', '.join('e.' + c for c in EVENT_COLS)}
FROM panel p JOIN event_days e USING (shipment_date)"""


@oracle("features_trend")
def _():
    return f"""WITH {panel_ctes()}
SELECT shipment_date, entity, n_shipments,
  CAST(date_diff('day', DATE '1995-01-01', shipment_date) AS INTEGER) AS days_since_start,
  CAST(year(shipment_date) * 12 + month(shipment_date) - (1995 * 12 + 1) AS INTEGER) AS month_index,
  round(CAST(CAST((dayofyear(shipment_date) - 1) / 365.0 AS FLOAT) AS DOUBLE), 6) AS year_progress
FROM panel"""


def volume_ctes(src: str = "panel", train_end: str = "DATE '2000-06-30'") -> str:
    return f"""
vol_stats AS (SELECT entity, avg(n_shipments) AS v FROM {src} WHERE shipment_date <= {train_end} GROUP BY entity)"""


def volume_cols(lo: float = 0.55, hi: float = 0.70, alias: str = "s") -> str:
    v = f"COALESCE({alias}.v, 0.0)"
    return (f"round(CAST(CAST({v} AS FLOAT) AS DOUBLE), 6) AS state_avg_volume, "
            f"CASE WHEN {v} < {lo} THEN 'tail' WHEN {v} >= {hi} THEN 'core' ELSE 'mid' END AS volume_tier")


@oracle("features_volume")
def _():
    return f"""WITH {panel_ctes()}, {volume_ctes()}
SELECT p.shipment_date, p.entity, p.n_shipments, {volume_cols()}
FROM panel p LEFT JOIN vol_stats s ON s.entity = p.entity"""


@oracle("features_default")
def _():
    flags = ", ".join(f"{v} AS {k}" for k, v in day_flags_sql().items())
    frame = "(PARTITION BY p.entity ORDER BY p.shipment_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    return f"""WITH {panel_ctes()}, {holiday_ctes()}, {event_ctes()}, {volume_ctes()}
SELECT p.shipment_date, p.entity, p.n_shipments,
  CAST(lag(p.n_shipments, 7) OVER w AS INTEGER) AS lag_7,
  CAST(lag(p.n_shipments, 14) OVER w AS INTEGER) AS lag_14,
  round(avg(p.n_shipments) OVER {frame}, 6) AS rolling_mean_7,
  round(stddev_samp(p.n_shipments) OVER {frame}, 6) AS rolling_std_7,
  CAST(isodow(p.shipment_date) - 1 AS INTEGER) AS day_of_week,
  CAST(month(p.shipment_date) AS INTEGER) AS month,
  CAST(isodow(p.shipment_date) >= 6 AS INTEGER) AS is_weekend,
  CAST(day(p.shipment_date) = 1 AS INTEGER) AS is_month_start,
  CAST(p.shipment_date = last_day(p.shipment_date) AS INTEGER) AS is_month_end,
  {flags},
  {', '.join('e.' + c for c in EVENT_COLS)},
  CAST(date_diff('day', DATE '1995-01-01', p.shipment_date) AS INTEGER) AS days_since_start,
  round(CAST(CAST((dayofyear(p.shipment_date) - 1) / 365.0 AS FLOAT) AS DOUBLE), 6) AS year_progress,
  {volume_cols()}
FROM panel p
LEFT JOIN holidays h ON h.hd = p.shipment_date
JOIN event_days e ON e.shipment_date = p.shipment_date
LEFT JOIN vol_stats s ON s.entity = p.entity
WINDOW w AS (PARTITION BY p.entity ORDER BY p.shipment_date)"""


# ---------------------------------------------------------------------------
# Folds, baselines, evaluation
# ---------------------------------------------------------------------------
def folds_values() -> str:
    rows = ", ".join(f"({f}, {_date(a)}, {_date(b)}, {_date(c)})" for f, a, b, c, _ in C.FOLD_SPEC)
    return f"SELECT * FROM (VALUES {rows}) t(fold_id, train_end, test_start, test_end)"


def backtest_ctes(src: str = "panel", season: int = 7) -> str:
    """CTEs ending in ``bt(model, fold_id, shipment_date, entity, n_shipments, y_pred, y_lower, y_upper)``."""
    return f"""
folds AS ({folds_values()}),
assigned AS (
  SELECT f.fold_id, p.shipment_date, p.entity, p.n_shipments,
         CASE WHEN p.shipment_date <= f.train_end THEN 'train' ELSE 'test' END AS split
  FROM {src} p CROSS JOIN folds f CROSS JOIN (SELECT MIN(shipment_date) AS ts FROM {src}) b
  WHERE (p.shipment_date BETWEEN b.ts AND f.train_end)
     OR (p.shipment_date BETWEEN f.test_start AND f.test_end)
),
tr AS (SELECT * FROM assigned WHERE split = 'train'),
te AS (SELECT fold_id, shipment_date, entity, CAST(n_shipments AS DOUBLE) AS n_shipments FROM assigned WHERE split = 'test'),
hz AS (SELECT fold_id, COUNT(DISTINCT shipment_date) AS horizon FROM te GROUP BY fold_id),
nv_state AS (
  SELECT fold_id, entity, CAST(arg_max(n_shipments, shipment_date) AS DOUBLE) AS last_value,
         CASE WHEN COUNT(d1) > 1 THEN stddev_samp(d1) ELSE 0.0 END AS resid_std
  FROM (SELECT *, n_shipments - lag(n_shipments) OVER (PARTITION BY fold_id, entity ORDER BY shipment_date) AS d1 FROM tr)
  GROUP BY fold_id, entity
),
tr_last AS (SELECT fold_id, MAX(shipment_date) AS last_date FROM tr GROUP BY fold_id),
steps AS (SELECT fold_id, unnest(range(0, horizon)) AS k FROM hz),
nv_pred AS (
  SELECT 'naive' AS model, s.fold_id, CAST(l.last_date + INTERVAL (st.k + 1) DAY AS DATE) AS shipment_date,
         s.entity, s.last_value AS y_pred,
         greatest(0.0, s.last_value - 1.28 * s.resid_std) AS y_lower, s.last_value + 1.28 * s.resid_std AS y_upper
  FROM nv_state s JOIN tr_last l USING (fold_id) JOIN steps st USING (fold_id)
),
sn_hist AS (
  SELECT *, n_shipments - lag(n_shipments, {season}) OVER (PARTITION BY fold_id, entity ORDER BY shipment_date) AS ds,
         row_number() OVER (PARTITION BY fold_id, entity ORDER BY shipment_date DESC) AS rn_desc
  FROM tr
),
sn_std AS (
  SELECT fold_id, entity, CASE WHEN COUNT(ds) > 1 THEN stddev_samp(ds) ELSE 0.0 END AS resid_std
  FROM sn_hist GROUP BY fold_id, entity
),
sn_vals AS (SELECT fold_id, entity, {season} - rn_desc AS pos, CAST(n_shipments AS DOUBLE) AS v FROM sn_hist WHERE rn_desc <= {season}),
sn_pred AS (
  SELECT 'seasonal_naive' AS model, s.fold_id, CAST(l.last_date + INTERVAL (st.k + 1) DAY AS DATE) AS shipment_date,
         s.entity, v.v AS y_pred,
         greatest(0.0, v.v - 1.28 * s.resid_std) AS y_lower, v.v + 1.28 * s.resid_std AS y_upper
  FROM sn_std s JOIN tr_last l USING (fold_id) JOIN steps st USING (fold_id)
  JOIN sn_vals v ON v.fold_id = s.fold_id AND v.entity = s.entity AND v.pos = st.k % {season}
),
bt AS (
  SELECT pr.model, pr.fold_id, pr.shipment_date, pr.entity, te.n_shipments, pr.y_pred, pr.y_lower, pr.y_upper
  FROM (SELECT * FROM nv_pred UNION ALL SELECT * FROM sn_pred) pr
  JOIN te ON te.fold_id = pr.fold_id AND te.entity = pr.entity AND te.shipment_date = pr.shipment_date
)"""


def _bt(body: str, extra: str = "") -> str:
    return f"WITH {panel_ctes()}, {backtest_ctes()}{extra} {body}"


WAPE = "sum(abs(n_shipments - y_pred)) / NULLIF(sum(abs(n_shipments)), 0)"
METRICS = (f"round({WAPE}, 6) AS wape, round(avg(abs(n_shipments - y_pred)), 6) AS mae, "
           "round(sqrt(avg(power(n_shipments - y_pred, 2))), 6) AS rmse, "
           "round(avg(y_pred - n_shipments), 6) AS bias, COUNT(*) AS n_rows")


@oracle("fold_sizes")
def _():
    return _bt("""SELECT fold_id, split, COUNT(*) AS n_rows, COUNT(DISTINCT shipment_date) AS n_days,
       MIN(shipment_date) AS first_date, MAX(shipment_date) AS last_date FROM assigned GROUP BY fold_id, split""")


def _bt_rows(model: str) -> str:
    return _bt(f"""SELECT model, fold_id, shipment_date, entity, round(n_shipments, 6) AS n_shipments,
       round(y_pred, 6) AS y_pred, round(y_lower, 6) AS y_lower, round(y_upper, 6) AS y_upper
FROM bt WHERE model = '{model}'""")


@oracle("backtest_naive")
def _():
    return _bt_rows("naive")


@oracle("backtest_seasonal_naive")
def _():
    return _bt_rows("seasonal_naive")


@oracle("backtest_metrics")
def _():
    return _bt(f"SELECT model, fold_id, {METRICS} FROM bt GROUP BY model, fold_id")


def _bt_days() -> str:
    flags = ", ".join(f"{v} AS {k}" for k, v in day_flags_sql("b.shipment_date").items())
    return f""", {holiday_ctes('bt')},
btd AS (SELECT b.*, {flags} FROM bt b LEFT JOIN holidays h ON h.hd = b.shipment_date)"""


@oracle("backtest_metrics_operational")
def _():
    return _bt(f"SELECT model, fold_id, {METRICS} FROM btd WHERE is_operational = 1 GROUP BY model, fold_id",
               _bt_days())


@oracle("wape_by_entity")
def _():
    return _bt(f"""SELECT model, fold_id, entity, round(sum(abs(n_shipments - y_pred)) / sum(abs(n_shipments)), 6) AS wape
FROM bt GROUP BY model, fold_id, entity HAVING sum(abs(n_shipments)) > 0""")


@oracle("wape_by_day_type")
def _():
    return _bt(f"""SELECT model, day_type, round(sum(abs(n_shipments - y_pred)) / sum(abs(n_shipments)), 6) AS wape
FROM btd GROUP BY model, day_type HAVING sum(abs(n_shipments)) > 0""", _bt_days())


@oracle("wape_near_events")
def _():
    return _bt(f"""SELECT model, round({WAPE}, 6) AS wape, COUNT(*) AS n_rows FROM bt
WHERE abs(date_diff('day', DATE '2000-11-24', shipment_date)) <= 3
   OR abs(date_diff('day', DATE '2001-11-23', shipment_date)) <= 3
GROUP BY model""")


def named_windows_values() -> str:
    rows = ", ".join(f"('{n}', {_date(a)}, {_date(b)})" for n, a, b in C.EVENT_WINDOWS)
    return f"SELECT * FROM (VALUES {rows}) t(event, ws, we)"


@oracle("event_window_wape")
def _():
    cols = ", ".join(f"round(sum(abs(n_shipments - y_pred)) FILTER (near) / nullif(sum(abs(n_shipments)) FILTER (near), 0), 6) AS {n}"
                     .replace("near", f"abs(date_diff('day', DATE '{d}', shipment_date)) <= 7")
                     for n, d in (("black_friday", "2000-11-24"), ("christmas", "2000-12-25"), ("valentine", "2001-06-12")))
    return _bt(f"SELECT model, round({WAPE}, 6) AS overall, {cols} FROM bt GROUP BY model")


@oracle("entity_performance")
def _():
    return _bt(f"""SELECT model, fold_id, entity, round({WAPE}, 6) AS wape, round(sum(n_shipments), 6) AS total,
       round(avg(n_shipments), 6) AS daily_mean FROM bt GROUP BY model, fold_id, entity""")


HOLDOUT_PERF = f""", perf AS (
  SELECT entity, {WAPE} AS wape, sum(n_shipments) AS total, avg(n_shipments) AS daily_mean
  FROM bt WHERE model = 'seasonal_naive' AND fold_id = 4 GROUP BY entity)"""


@oracle("best_worst_entities")
def _():
    return _bt("""SELECT entity, round(wape, 6) AS wape, round(total, 6) AS total, round(daily_mean, 6) AS daily_mean, rank_group FROM (
  (SELECT *, 'best' AS rank_group FROM perf WHERE wape IS NOT NULL ORDER BY wape ASC, entity ASC LIMIT 5)
  UNION ALL
  (SELECT *, 'worst' AS rank_group FROM perf WHERE wape IS NOT NULL ORDER BY wape DESC, entity ASC LIMIT 5))""",
               HOLDOUT_PERF)


MET = f""", met AS (SELECT model, fold_id, {WAPE} AS wape, avg(abs(n_shipments - y_pred)) AS mae,
  sqrt(avg(power(n_shipments - y_pred, 2))) AS rmse FROM bt GROUP BY model, fold_id)"""


@oracle("fold_winner")
def _():
    return _bt("""SELECT fold_id, round(n, 6) AS naive_wape, round(s, 6) AS seasonal_naive_wape,
       round(100.0 * (n - s) / s, 2) AS delta_pct, CASE WHEN n < s THEN 'naive' ELSE 'seasonal_naive' END AS winner
FROM (SELECT fold_id, max(CASE WHEN model = 'naive' THEN wape END) AS n,
             max(CASE WHEN model = 'seasonal_naive' THEN wape END) AS s FROM met GROUP BY fold_id)""", MET)


@oracle("metric_mean_std")
def _():
    cols = ", ".join(f"round({f}({c}), 6) AS {c}_{n}" for c in ("wape", "mae", "rmse")
                     for n, f in (("mean", "avg"), ("std", "stddev_samp")))
    return _bt(f"SELECT model, {cols} FROM met GROUP BY model", MET)


@oracle("wape_pivot_uplift")
def _():
    return _bt("""SELECT fold_id, round(n, 6) AS naive, round(s, 6) AS seasonal_naive, round(n - s, 6) AS uplift
FROM (SELECT fold_id, max(CASE WHEN model = 'naive' THEN wape END) AS n,
             max(CASE WHEN model = 'seasonal_naive' THEN wape END) AS s FROM met GROUP BY fold_id)""", MET)


@oracle("spearman_volume_wape")
def _():
    # The t distribution's finite series: odd and even degrees of freedom (n - 2).
    return _bt("""SELECT round(r, 6) AS spearman, n, round(1 - CASE WHEN odd = 1 THEN 2 / pi() * (asin(abs(r)) + abs(r) * tail)
                  ELSE abs(r) * tail END, 6) AS p_value FROM sp, series""",
               HOLDOUT_PERF + """,
sp AS (
  SELECT corr(rx, ry) AS r, COUNT(*) AS n, COUNT(*) % 2 AS odd FROM (
    SELECT (rank() OVER (ORDER BY total) + (COUNT(*) OVER (PARTITION BY total) - 1) / 2.0) AS rx,
           (rank() OVER (ORDER BY wape) + (COUNT(*) OVER (PARTITION BY wape) - 1) / 2.0) AS ry FROM perf)
),
terms AS (SELECT odd, r, n, unnest(range(0, CAST((n - 2 - odd) / 2 AS BIGINT))) AS j FROM sp),
factors AS (
  SELECT *, exp(sum(CASE WHEN j = 0 THEN 0 WHEN odd = 1 THEN ln(2.0 * j / (2 * j + 1)) ELSE ln((2.0 * j - 1) / (2 * j)) END)
                OVER (ORDER BY j)) AS f FROM terms
),
series AS (SELECT coalesce(sum(f * pow(1 - r * r, j + odd / 2.0)), 0) AS tail FROM factors)""")


# ---------------------------------------------------------------------------
# Costs
# ---------------------------------------------------------------------------
def grid_values() -> str:
    rows = ", ".join(f"({i}, {a})" for i, a in enumerate(C.ALPHA_GRID))
    return f"SELECT pos, CAST(alpha AS DOUBLE) AS alpha FROM (VALUES {rows}) t(pos, alpha)"


def ratio_values() -> str:
    rows = ", ".join(f"({r})" for r in C.COST_RATIOS)
    return f"SELECT CAST(cost_ratio AS DOUBLE) AS cost_ratio FROM (VALUES {rows}) t(cost_ratio)"


PAIRED = f""", {holiday_ctes('bt')},
paired AS (
  SELECT p.*, {day_flags_sql('p.shipment_date')['is_operational']} AS is_operational FROM (
    SELECT fold_id, shipment_date, entity, max(n_shipments) AS n_shipments,
           max(CASE WHEN model = 'naive' THEN y_pred END) AS ym,
           max(CASE WHEN model = 'seasonal_naive' THEN y_pred END) AS yb
    FROM bt GROUP BY fold_id, shipment_date, entity) p
  LEFT JOIN holidays h ON h.hd = p.shipment_date
)"""


def gain_sql(group: str, source: str) -> str:
    """``source`` has columns {group}, n_shipments, ym, yb, shipment_date."""
    return f"""
src AS ({source}),
per_alpha AS (
  SELECT s.{group}, r.cost_ratio, g.pos, g.alpha,
         sum(r.cost_ratio * greatest(s.n_shipments - greatest(s.ym * (1 + g.alpha), 0), 0)
             + greatest(greatest(s.ym * (1 + g.alpha), 0) - s.n_shipments, 0)) AS cost
  FROM src s CROSS JOIN ({ratio_values()}) r CROSS JOIN ({grid_values()}) g
  GROUP BY s.{group}, r.cost_ratio, g.pos, g.alpha
),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group}, cost_ratio ORDER BY round(cost, 6), pos) AS rn
                 FROM per_alpha) WHERE rn = 1
),
raw AS (
  SELECT s.{group}, r.cost_ratio,
         sum(r.cost_ratio * greatest(s.n_shipments - s.ym, 0) + greatest(s.ym - s.n_shipments, 0)) AS cm,
         sum(r.cost_ratio * greatest(s.n_shipments - s.yb, 0) + greatest(s.yb - s.n_shipments, 0)) AS cb,
         COUNT(*) AS n_rows, COUNT(DISTINCT s.shipment_date) AS n_days
  FROM src s CROSS JOIN ({ratio_values()}) r GROUP BY s.{group}, r.cost_ratio
),
gains AS (
  SELECT raw.{group}, raw.cost_ratio, raw.cost_ratio AS c_under, CAST(1.0 AS DOUBLE) AS c_over,
         raw.cb - raw.cm AS gain_no_tuning, raw.cb - best.cost AS gain_tuned, best.alpha AS best_alpha,
         raw.cm AS cost_model_no_tuning, best.cost AS cost_model_tuned, raw.cb AS cost_baseline,
         (raw.cb - best.cost) - (raw.cb - raw.cm) AS tuning_uplift, raw.n_rows, raw.n_days
  FROM raw JOIN best ON best.{group} = raw.{group} AND best.cost_ratio = raw.cost_ratio
)"""


GAIN_SELECT = ", ".join(f"round({c}, 6) AS {c}" for c in (
    "gain_no_tuning", "gain_tuned", "best_alpha", "cost_model_no_tuning", "cost_model_tuned",
    "cost_baseline", "tuning_uplift"))


@oracle("gain_by_fold")
def _():
    src = "SELECT fold_id, n_shipments, ym, yb, shipment_date FROM paired WHERE is_operational = 1"
    return _bt(f"SELECT fold_id, cost_ratio, c_under, c_over, {GAIN_SELECT}, n_rows, n_days FROM gains",
               PAIRED + "," + gain_sql("fold_id", src))


@oracle("gain_in_events")
def _():
    src = (f"SELECT w.event, p.n_shipments, p.ym, p.yb, p.shipment_date FROM paired p "
           f"JOIN ({named_windows_values()}) w ON p.shipment_date BETWEEN w.ws AND w.we "
           f"WHERE p.is_operational = 1")
    return _bt(f"SELECT event, cost_ratio, c_under, c_over, {GAIN_SELECT}, n_rows, n_days FROM gains",
               PAIRED + "," + gain_sql("event", src))


@oracle("gain_totals")
def _():
    src = "SELECT fold_id, n_shipments, ym, yb, shipment_date FROM paired WHERE is_operational = 1"
    return _bt("""SELECT cost_ratio, round(sum(gain_no_tuning), 6) AS total_gain_no_tuning,
       round(sum(gain_tuned), 6) AS total_gain_tuned,
       COUNT(*) FILTER (WHERE gain_no_tuning > 0) AS folds_won_no_tuning,
       COUNT(*) FILTER (WHERE gain_tuned > 0) AS folds_won_tuned, COUNT(*) AS n_folds
FROM gains GROUP BY cost_ratio""", PAIRED + "," + gain_sql("fold_id", src))


@oracle("best_multiplier_by_entity")
def _():
    return _bt(f"""SELECT fold_id, entity, round(alpha, 6) AS best_alpha, round(cost, 6) AS best_cost FROM (
  SELECT *, row_number() OVER (PARTITION BY fold_id, entity ORDER BY round(cost, 6), pos) AS rn FROM (
    SELECT b.fold_id, b.entity, g.pos, g.alpha,
           sum(3.0 * greatest(b.n_shipments - greatest(b.y_pred * (1 + g.alpha), 0), 0)
               + 1.0 * greatest(greatest(b.y_pred * (1 + g.alpha), 0) - b.n_shipments, 0)) AS cost
    FROM bt b CROSS JOIN ({grid_values()}) g WHERE b.model = 'seasonal_naive'
    GROUP BY b.fold_id, b.entity, g.pos, g.alpha)) WHERE rn = 1""")


# ---------------------------------------------------------------------------
# Conformal intervals and batch scoring
# ---------------------------------------------------------------------------
def sn_ctes(name: str, src: str, keys: str, horizon_src: str, season: int = 7) -> str:
    """Seasonal naive keyed by ``keys`` (comma list, at least one column):
    ``src(keys, shipment_date, entity, n_shipments)`` and
    ``horizon_src(keys, horizon)`` -> ``{name}_pred(keys, shipment_date,
    entity, y_pred, y_lower, y_upper)``."""
    kl = [k.strip() for k in keys.split(",")]
    on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in kl)
    return f"""
{name}_hist AS (
  SELECT *, n_shipments - lag(n_shipments, {season}) OVER (PARTITION BY {keys}, entity ORDER BY shipment_date) AS ds,
         row_number() OVER (PARTITION BY {keys}, entity ORDER BY shipment_date DESC) AS rn_desc
  FROM {src}
),
{name}_std AS (
  SELECT {keys}, entity, CASE WHEN COUNT(ds) > 1 THEN stddev_samp(ds) ELSE 0.0 END AS resid_std
  FROM {name}_hist GROUP BY {keys}, entity
),
{name}_last AS (SELECT {keys}, MAX(shipment_date) AS last_date FROM {src} GROUP BY {keys}),
{name}_vals AS (SELECT {keys}, entity, {season} - rn_desc AS pos, CAST(n_shipments AS DOUBLE) AS v
                FROM {name}_hist WHERE rn_desc <= {season}),
{name}_steps AS (SELECT {keys}, unnest(range(0, horizon)) AS k FROM {horizon_src}),
{name}_pred AS (
  SELECT {', '.join('s.' + k for k in kl)}, CAST(l.last_date + INTERVAL (st.k + 1) DAY AS DATE) AS shipment_date,
         s.entity, v.v AS y_pred, greatest(0.0, v.v - 1.28 * s.resid_std) AS y_lower, v.v + 1.28 * s.resid_std AS y_upper
  FROM {name}_std s JOIN {name}_last l ON {on('l', 's')} JOIN {name}_steps st ON {on('st', 's')}
  JOIN {name}_vals v ON {on('v', 's')} AND v.entity = s.entity AND v.pos = st.k % {season}
)"""


TRAIN_END_SQL = _date(C.FOLD_SPEC[-1][1])
HOLDOUT_SQL = (_date(C.FOLD_SPEC[-1][2]), _date(C.FOLD_SPEC[-1][3]))


def calib_lengths_values(lengths=None) -> str:
    rows = ", ".join(f"({c})" for c in (lengths or C.CALIBRATION_LENGTHS))
    return f"SELECT * FROM (VALUES {rows}) t(calib_days)"


def conformal_ctes(lengths_sql: str) -> str:
    """CTEs ``hist`` (panel up to the training end) and ``offs(calib_days,
    lower_offset, upper_offset, n_residuals, coverage)``."""
    return f"""
hist AS (SELECT * FROM panel WHERE shipment_date <= {TRAIN_END_SQL}),
cal AS ({lengths_sql}),
hk AS (
  SELECT c.calib_days, h.*,
         h.shipment_date >= CAST((SELECT MAX(shipment_date) FROM hist) - INTERVAL (c.calib_days - 1) DAY AS DATE) AS is_cal
  FROM hist h CROSS JOIN cal c
),
fitp AS (SELECT calib_days, shipment_date, entity, n_shipments FROM hk WHERE NOT is_cal),
calp AS (SELECT calib_days, shipment_date, entity, n_shipments FROM hk WHERE is_cal),
cal_hz AS (SELECT calib_days, COUNT(DISTINCT shipment_date) AS horizon FROM calp GROUP BY calib_days),
{sn_ctes('cf', 'fitp', 'calib_days', 'cal_hz')},
{holiday_ctes('calp')},
resid AS (
  SELECT c.calib_days, c.n_shipments - p.y_pred AS residual
  FROM calp c JOIN cf_pred p ON p.calib_days = c.calib_days AND p.entity = c.entity AND p.shipment_date = c.shipment_date
  LEFT JOIN holidays h ON h.hd = c.shipment_date
  WHERE {day_flags_sql('c.shipment_date')['is_operational']} = 1
),
q AS (
  SELECT calib_days, quantile_cont(residual, 0.05) AS lower_offset, quantile_cont(residual, 0.95) AS upper_offset,
         COUNT(*) AS n_residuals FROM resid GROUP BY calib_days
),
offs AS (
  SELECT q.*, (SELECT avg(CAST(r.residual BETWEEN q.lower_offset AND q.upper_offset AS DOUBLE))
               FROM resid r WHERE r.calib_days = q.calib_days) AS coverage FROM q
),
hist1 AS (SELECT 0 AS g, shipment_date, entity, n_shipments FROM hist)"""


def full_forecast_ctes(horizon: int) -> str:
    return f"""
fc_hz AS (SELECT 0 AS g, {horizon} AS horizon),
{sn_ctes('fc', 'hist1', 'g', 'fc_hz')},
fc AS (
  SELECT p.shipment_date, p.entity, p.y_pred, o.calib_days,
         greatest(0.0, p.y_pred + o.lower_offset) AS y_lower, p.y_pred + o.upper_offset AS y_upper
  FROM fc_pred p CROSS JOIN offs o
)"""


@oracle("conformal_offsets")
def _():
    return f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}
SELECT round(lower_offset, 6) AS lower_offset, round(upper_offset, 6) AS upper_offset, n_residuals,
       round(coverage, 6) AS coverage FROM offs"""


@oracle("conformal_coverage_by_calibration")
def _():
    return f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values())}, {full_forecast_ctes(91)},
truth AS (SELECT * FROM panel WHERE shipment_date BETWEEN {HOLDOUT_SQL[0]} AND {HOLDOUT_SQL[1]}),
cov AS (
  SELECT f.calib_days, avg(CAST(t.n_shipments BETWEEN f.y_lower AND f.y_upper AS DOUBLE)) AS holdout_coverage,
         avg(f.y_upper - f.y_lower) AS mean_width, COUNT(*) AS n_rows
  FROM fc f JOIN truth t ON t.shipment_date = f.shipment_date AND t.entity = f.entity GROUP BY f.calib_days
)
SELECT o.calib_days, round(o.lower_offset, 6) AS lower_offset, round(o.upper_offset, 6) AS upper_offset,
       o.n_residuals, round(o.coverage, 6) AS calib_coverage, round(c.holdout_coverage, 6) AS holdout_coverage,
       round(c.mean_width, 6) AS mean_width, c.n_rows
FROM offs o JOIN cov c USING (calib_days)"""


@oracle("conformal_forecast")
def _():
    return f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}, {full_forecast_ctes(91)}
SELECT shipment_date, entity, round(y_pred, 6) AS y_pred, round(y_lower, 6) AS y_lower,
       round(y_upper, 6) AS y_upper FROM fc"""


def requests_sql() -> str:
    from demandgrid.plans.queries import REQUESTS

    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "TRUE" if x else "FALSE"
        if isinstance(x, (int, float)):
            return f"CAST({x} AS DOUBLE)"
        if isinstance(x, list):
            return "CAST([" + ", ".join(f"'{e}'" for e in x) + "] AS VARCHAR[])"
        if hasattr(x, "isoformat"):
            return _date(x)
        return f"'{x}'"
    rows = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in REQUESTS)
    return (f"SELECT * FROM (VALUES {rows}) t(request_id, start_date, end_date, entities, alpha, "
            f"cost_ratio, include_intervals, include_cost_aware)")


REQ_CHECK = f"""
req AS ({requests_sql()}),
known AS (SELECT DISTINCT entity FROM panel),
unknown AS (
  SELECT request_id, string_agg(e, ',' ORDER BY e) AS u FROM (
    SELECT DISTINCT request_id, unnest(entities) AS e FROM req) x
  WHERE e NOT IN (SELECT entity FROM known) GROUP BY request_id
),
checked AS (
  SELECT r.*, CASE
    WHEN r.end_date < r.start_date THEN 'end_date before start_date'
    WHEN date_diff('day', r.start_date, r.end_date) + 1 > {REQUEST_DAYS} THEN 'window longer than {REQUEST_DAYS} days'
    WHEN r.alpha IS NOT NULL AND NOT (r.alpha BETWEEN {ALPHA_LOW} AND {ALPHA_HIGH}) THEN 'alpha out of range'
    WHEN r.cost_ratio IS NOT NULL AND NOT (r.cost_ratio BETWEEN {RATIO_LOW} AND {RATIO_HIGH}) THEN 'cost_ratio out of range'
    WHEN r.start_date <= {TRAIN_END_SQL} THEN 'start_date not after last training date'
    WHEN u.u IS NOT NULL THEN 'unknown entities: ' || u.u
  END AS reason
  FROM req r LEFT JOIN unknown u USING (request_id)
)"""


@oracle("request_checks")
def _():
    return f"WITH {panel_ctes()}, {REQ_CHECK} SELECT request_id, reason FROM checked"


def scored_ctes(horizon: int) -> str:
    da, dr = SERVER_ALPHA, SERVER_RATIO
    return f"""{REQ_CHECK}, {conformal_ctes(calib_lengths_values([60]))}, {full_forecast_ctes(horizon)},
days AS (
  SELECT c.*, CAST(unnest(range(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM checked c WHERE reason IS NULL
),
scored AS (
  SELECT d.request_id, f.shipment_date AS date, f.entity, f.y_pred AS point,
         CASE WHEN d.include_intervals THEN f.y_lower END AS lower_90,
         CASE WHEN d.include_intervals THEN f.y_upper END AS upper_90,
         CASE WHEN d.include_cost_aware THEN greatest(0.0, f.y_pred + COALESCE(d.alpha, {da}) *
              CASE WHEN COALESCE(d.alpha, {da}) >= 0 THEN f.y_upper - f.y_pred ELSE f.y_pred - f.y_lower END) END AS recommended,
         CASE WHEN d.include_cost_aware THEN COALESCE(d.alpha, {da}) END AS alpha_used,
         CASE WHEN d.include_cost_aware THEN COALESCE(d.cost_ratio, {dr}) END AS cost_ratio_used,
         CASE WHEN d.include_cost_aware THEN CASE WHEN d.alpha IS NOT NULL THEN 'request' ELSE 'server_default' END END AS alpha_source,
         CASE WHEN d.include_cost_aware THEN CASE WHEN d.cost_ratio IS NOT NULL THEN 'request' ELSE 'server_default' END END AS cost_ratio_source
  FROM days d JOIN fc f ON f.shipment_date = d.d
  WHERE len(d.entities) = 0 OR list_contains(d.entities, f.entity)
)"""


# The training end is March 31, 2001; no valid request reaches past June 30.
SCORED_DAYS = 91


@oracle("batch_scoring")
def _():
    return f"""WITH {panel_ctes()}, {scored_ctes(SCORED_DAYS)}
SELECT request_id, date, entity, round(point, 6) AS point, round(lower_90, 6) AS lower_90,
       round(upper_90, 6) AS upper_90, round(recommended, 6) AS recommended, alpha_used, cost_ratio_used,
       alpha_source, cost_ratio_source FROM scored"""


@oracle("alpha_sweep")
def _():
    return f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}, {full_forecast_ctes(14)}
SELECT f.shipment_date, f.entity, a.alpha, round(f.y_pred, 6) AS y_pred,
       round(greatest(0.0, f.y_pred + a.alpha * CASE WHEN a.alpha >= 0 THEN f.y_upper - f.y_pred
                                                  ELSE f.y_pred - f.y_lower END), 6) AS recommended
FROM fc f CROSS JOIN (SELECT CAST(alpha AS DOUBLE) AS alpha FROM (VALUES (-0.5), (0.0), (0.5), (1.0)) t(alpha)) a"""


@oracle("day_snapshot")
def _():
    return f"""WITH {panel_ctes()}, {scored_ctes(SCORED_DAYS)}
SELECT entity, round(point, 6) AS point, round(recommended, 6) AS recommended FROM scored
WHERE request_id = 'r1' AND date = DATE '2001-04-02' ORDER BY recommended DESC, entity"""


# ---------------------------------------------------------------------------
# Exploratory aggregates, checks, profiles, second panel
# ---------------------------------------------------------------------------
NATIONAL = """, national AS (SELECT shipment_date, CAST(SUM(n_shipments) AS BIGINT) AS total FROM panel GROUP BY shipment_date)"""


def national_days_ctes() -> str:
    dow = "(isodow(n.shipment_date) - 1)"
    hol = "(h.hd IS NOT NULL)"
    dt = (f"CASE WHEN {dow} = 6 THEN 'sunday' WHEN {hol} THEN 'holiday' WHEN {dow} = 5 THEN 'saturday' "
          f"ELSE 'business_day' END")
    return f"""{NATIONAL}, {holiday_ctes('national')},
nd AS (
  SELECT n.*, {dt} AS day_type FROM national n LEFT JOIN holidays h ON h.hd = n.shipment_date
),
ndays AS (
  SELECT *, CAST(day_type = 'business_day' AS INTEGER) AS is_business_day,
         CAST(day_type IN ('business_day', 'saturday') AS INTEGER) AS is_operational FROM nd
)"""


def _p(body: str, extra: str = "") -> str:
    return f"WITH {panel_ctes()}{extra} {body}"


@oracle("national_daily_total")
def _():
    return _p("SELECT * FROM national", NATIONAL)


@oracle("monthly_summary")
def _():
    return _p("""SELECT strftime(shipment_date, '%Y-%m') AS year_month, COUNT(*) AS n_days,
       round(avg(total), 1) AS mean_per_day, CAST(sum(total) AS BIGINT) AS total
FROM national GROUP BY 1""", NATIONAL)


@oracle("weekday_stats")
def _():
    return _p("""SELECT *, round(100.0 * a / max(a) OVER (), 6) AS pct_of_peak FROM (
  SELECT CAST(isodow(shipment_date) - 1 AS INTEGER) AS dow_num, dayname(shipment_date) AS dow_name,
         round(avg(total), 6) AS avg_value, round(quantile_cont(total::DOUBLE, 0.5), 6) AS median_value,
         round(stddev_samp(total), 6) AS std_value, COUNT(*) AS n_days, avg(total) AS a
  FROM ndays WHERE is_business_day = 1 GROUP BY 1, 2) x""".replace("SELECT *,", "SELECT dow_num, dow_name, avg_value, median_value, std_value, n_days,"),
              national_days_ctes())


@oracle("day_type_stats")
def _():
    return _p("""SELECT day_type, COUNT(*) AS n_days, round(avg(total), 6) AS avg_value,
       round(quantile_cont(total::DOUBLE, 0.5), 6) AS median_value, min(total) AS min_value, max(total) AS max_value
FROM ndays GROUP BY day_type""", national_days_ctes())


@oracle("day_type_counts")
def _():
    return _p("SELECT day_type, COUNT(*) AS count FROM ndays GROUP BY day_type", national_days_ctes())


@oracle("describe_daily_total")
def _():
    return _p("""SELECT COUNT(total) AS count, round(avg(total), 6) AS mean, round(stddev_samp(total), 6) AS std,
       round(CAST(min(total) AS DOUBLE), 6) AS min, round(quantile_cont(total::DOUBLE, 0.25), 6) AS p25,
       round(quantile_cont(total::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(total::DOUBLE, 0.75), 6) AS p75,
       round(CAST(max(total) AS DOUBLE), 6) AS max FROM national""", NATIONAL)


@oracle("operational_share")
def _():
    return _p("""SELECT round(CAST(sum(CASE WHEN is_operational = 1 THEN total ELSE 0 END) AS DOUBLE) / sum(total), 6) AS share,
       COUNT(*) FILTER (WHERE is_operational = 1) AS n_kept, COUNT(*) AS n_total FROM ndays""", national_days_ctes())


@oracle("month_weekday_matrix")
def _():
    cols = ", ".join(f"round(avg(CASE WHEN dayname(shipment_date) = '{d}' THEN total END), 6) AS {d}"
                     for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"))
    return _p(f"SELECT strftime(shipment_date, '%Y-%m') AS year_month, {cols} FROM ndays "
              f"WHERE is_business_day = 1 GROUP BY 1", national_days_ctes())


@oracle("zero_business_days")
def _():
    flags = day_flags_sql()
    return _p(f"""SELECT p.entity, COUNT(*) AS n_zero_business_days FROM panel p
LEFT JOIN holidays h ON h.hd = p.shipment_date
WHERE p.n_shipments = 0 AND {flags['is_business_day']} = 1 GROUP BY p.entity""", ", " + holiday_ctes())


@oracle("panel_density_check")
def _():
    return f"""WITH {panel_ctes('nation')}, {panel_ctes('region', 'rpanel')}
SELECT COUNT(DISTINCT shipment_date) * COUNT(DISTINCT entity) AS expected, COUNT(*) AS actual,
       'panel_nation' AS table_name,
       CASE WHEN COUNT(DISTINCT shipment_date) * COUNT(DISTINCT entity) = COUNT(*) THEN 'ok' ELSE 'MISMATCH' END AS status
FROM panel
UNION ALL
SELECT COUNT(DISTINCT shipment_date) * COUNT(DISTINCT entity), COUNT(*), 'panel_region',
       CASE WHEN COUNT(DISTINCT shipment_date) * COUNT(DISTINCT entity) = COUNT(*) THEN 'ok' ELSE 'MISMATCH' END
FROM rpanel"""


@oracle("table_row_counts")
def _():
    from demandgrid.sources.tables import TABLES
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES)


@oracle("table_checks")
def _():
    def nulls(t, cols, src=None):
        return " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, 'not_null' AS \"check\", '{c}' AS column_name, "
            f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_violations FROM {src or t}" for c in cols.split())

    def rule(t, name, pred, src=None):
        return (f"SELECT '{t}' AS table_name, 'rule' AS \"check\", '{name}' AS column_name, "
                f"CAST(COUNT(*) FILTER (WHERE NOT ({pred})) AS BIGINT) AS n_violations FROM {src or t}")

    def dup(t, key):
        return (f"SELECT '{t}' AS table_name, 'primary_key' AS \"check\", '{key.replace(' ', '')}' AS column_name, "
                f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_violations FROM "
                f"(SELECT COUNT(*) AS n FROM {t} GROUP BY {key} HAVING COUNT(*) > 1) d")

    def fk(t, ck, p, pk):
        return (f"SELECT '{t}' AS table_name, 'foreign_key' AS \"check\", '{ck}->{pk}' AS column_name, "
                f"CAST(COUNT(*) AS BIGINT) AS n_violations FROM {t} c "
                f"WHERE c.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pk} = c.{ck})")
    parts = [nulls("lineitem", "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_shipdate"),
             nulls("orders", "o_orderkey o_custkey o_orderstatus o_orderdate"), nulls("customer", "c_custkey c_nationkey"),
             nulls("supplier", "s_suppkey s_nationkey"), nulls("part", "p_partkey"),
             nulls("nation", "n_nationkey n_name n_regionkey"), nulls("region", "r_regionkey r_name"),
             nulls("panel_nation", "shipment_date entity n_shipments", "panel"),
             rule("lineitem", "l_quantity_positive", "l_quantity > 0"),
             rule("lineitem", "l_discount_0_1", "l_discount BETWEEN 0 AND 1"),
             rule("orders", "o_orderstatus_len_1", "length(o_orderstatus) = 1"),
             rule("panel_nation", "n_shipments_nonneg", "n_shipments >= 0", "panel"),
             dup("lineitem", "l_orderkey, l_linenumber"), dup("orders", "o_orderkey"),
             dup("customer", "c_custkey"),
             fk("orders", "o_custkey", "customer", "c_custkey"),
             fk("lineitem", "l_orderkey", "orders", "o_orderkey"),
             fk("lineitem", "l_partkey", "part", "p_partkey"),
             fk("lineitem", "l_suppkey", "supplier", "s_suppkey"),
             fk("customer", "c_nationkey", "nation", "n_nationkey"),
             fk("supplier", "s_nationkey", "nation", "n_nationkey"),
             fk("nation", "n_regionkey", "region", "r_regionkey")]
    return f"WITH {panel_ctes()} " + "\nUNION ALL ".join(parts)


# Columns of the given tables.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label", "pages": "page_id url html", "benchmark": "item_id text",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


@oracle("column_profile")
def _():
    kinds = ("CASE typeof(min({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END")
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {kinds.format(c=c)} AS data_type, "
        f"(count(*) - count({c}))::BIGINT AS n_nulls, round(100.0 * (count(*) - count({c})) / nullif(count(*), 0), 2) AS pct_nulls, "
        f"count(DISTINCT {c})::BIGINT AS n_distinct FROM {t}"
        for t, columns in TABLE_COLUMNS.items() for c in columns.split())


@oracle("table_samples")
def _():
    keys = {"lineitem": "l_orderkey, l_linenumber", "conversations": "conv_id, turn"}
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, list(CAST({'len(embedding)' if c == 'embedding' else c} AS VARCHAR) ORDER BY pos) AS sample "
        f"FROM (SELECT *, row_number() OVER (ORDER BY {keys.get(t, columns.split()[0])}) AS pos FROM {t}) WHERE pos <= 3"
        for t, columns in TABLE_COLUMNS.items() for c in columns.split())


EVENTS_PANEL = """
ev_raw AS (SELECT CAST(ts AS DATE) AS shipment_date, event_type AS entity, COUNT(*) AS n
           FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2),
ev_b AS (SELECT MIN(shipment_date) AS lo, MAX(shipment_date) AS hi FROM ev_raw),
ev_spine AS (SELECT CAST(d AS DATE) AS shipment_date FROM ev_b,
             range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
ev_panel AS (
  SELECT g.shipment_date, g.entity, CAST(COALESCE(r.n, 0) AS BIGINT) AS n_shipments
  FROM (SELECT * FROM ev_spine CROSS JOIN (SELECT DISTINCT entity FROM ev_raw)) g
  LEFT JOIN ev_raw r ON r.shipment_date = g.shipment_date AND r.entity = g.entity
)"""


@oracle("events_panel")
def _():
    return f"WITH {EVENTS_PANEL} SELECT * FROM ev_panel"


@oracle("events_panel_features")
def _():
    frame = "(PARTITION BY entity ORDER BY shipment_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    return f"""WITH {EVENTS_PANEL}
SELECT shipment_date, entity, n_shipments,
  CAST(lag(n_shipments, 1) OVER w AS INTEGER) AS lag_1, CAST(lag(n_shipments, 7) OVER w AS INTEGER) AS lag_7,
  round(CASE WHEN count(n_shipments) OVER {frame} >= 2 THEN avg(n_shipments) OVER {frame} END, 6) AS rolling_mean_7,
  round(CASE WHEN count(n_shipments) OVER {frame} >= 2 THEN stddev_samp(n_shipments) OVER {frame} END, 6) AS rolling_std_7
FROM ev_panel WINDOW w AS (PARTITION BY entity ORDER BY shipment_date)"""


@oracle("holiday_calendar")
def _():
    return f"WITH {panel_ctes()}, {holiday_ctes()} SELECT hd AS holiday_date FROM holidays"


@oracle("fold_feature_table")
def _():
    flags = ", ".join(f"{v} AS {k}" for k, v in day_flags_sql("a.shipment_date").items())
    frame = "(PARTITION BY a.fold_id, a.entity ORDER BY a.shipment_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    feats = f"""
feat AS (
  SELECT a.fold_id, a.split, a.shipment_date, a.entity, a.n_shipments,
    CAST(lag(a.n_shipments, 7) OVER w AS INTEGER) AS lag_7,
    CAST(lag(a.n_shipments, 14) OVER w AS INTEGER) AS lag_14,
    round(avg(a.n_shipments) OVER {frame}, 6) AS rolling_mean_7,
    round(stddev_samp(a.n_shipments) OVER {frame}, 6) AS rolling_std_7,
    CAST(isodow(a.shipment_date) - 1 AS INTEGER) AS day_of_week,
    CAST(month(a.shipment_date) AS INTEGER) AS month,
    CAST(isodow(a.shipment_date) >= 6 AS INTEGER) AS is_weekend,
    CAST(day(a.shipment_date) = 1 AS INTEGER) AS is_month_start,
    CAST(a.shipment_date = last_day(a.shipment_date) AS INTEGER) AS is_month_end,
    {flags},
    {', '.join('e.' + c for c in EVENT_COLS)},
    CAST(date_diff('day', DATE '1995-01-01', a.shipment_date) AS INTEGER) AS days_since_start,
    round(CAST(CAST((dayofyear(a.shipment_date) - 1) / 365.0 AS FLOAT) AS DOUBLE), 6) AS year_progress,
    {volume_cols()}
  FROM assigned a
  LEFT JOIN holidays h ON h.hd = a.shipment_date
  JOIN event_days e ON e.shipment_date = a.shipment_date
  LEFT JOIN (SELECT fold_id, entity, avg(n_shipments) AS v FROM assigned WHERE split = 'train'
             GROUP BY fold_id, entity) s ON s.fold_id = a.fold_id AND s.entity = a.entity
  WINDOW w AS (PARTITION BY a.fold_id, a.entity ORDER BY a.shipment_date)
)"""
    cols = ("lag_7, lag_14, rolling_mean_7, rolling_std_7, day_of_week, month, is_weekend, is_month_start, "
            "is_month_end, is_holiday, is_business_day, is_saturday, is_sunday, is_operational, day_type, "
            + ", ".join(EVENT_COLS) + ", days_since_start, year_progress, state_avg_volume, volume_tier")
    notnull = " AND ".join(f"{c.strip()} IS NOT NULL" for c in cols.split(",")
                           if c.strip() not in ("is_operational", "day_type"))
    return _bt(f"SELECT fold_id, split, shipment_date, entity, n_shipments, {cols} FROM feat "
               f"WHERE is_operational = 1 AND {notnull}",
               f", {holiday_ctes('assigned')}, {event_ctes('assigned')}, {feats}")


@oracle("model_info")
def _():
    return f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}, {full_forecast_ctes(91)},
truth AS (SELECT * FROM panel WHERE shipment_date BETWEEN {HOLDOUT_SQL[0]} AND {HOLDOUT_SQL[1]}),
ev AS (
  SELECT MIN(f.shipment_date) AS ws, MAX(f.shipment_date) AS we,
         round(sum(abs(t.n_shipments - f.y_pred)) / NULLIF(sum(abs(t.n_shipments)), 0), 4) AS wape,
         round(avg(abs(t.n_shipments - f.y_pred)), 4) AS mae,
         round(sqrt(avg(power(t.n_shipments - f.y_pred, 2))), 4) AS rmse
  FROM fc f JOIN truth t ON t.shipment_date = f.shipment_date AND t.entity = f.entity
),
g AS (SELECT list_sort(list(DISTINCT entity)) AS groups, MAX(shipment_date) AS ltd FROM hist)
SELECT '1' AS version, g.ltd AS last_train_date, g.ltd AS data_cutoff, 1 AS n_features,
       CAST(len(g.groups) AS INTEGER) AS n_groups, g.groups, ev.ws AS eval_window_start, ev.we AS eval_window_end,
       ev.wape AS eval_wape, ev.mae AS eval_mae, ev.rmse AS eval_rmse,
       'holdout after the last training date' AS evaluation_note,
       round(o.lower_offset, 6) AS lower_offset, round(o.upper_offset, 6) AS upper_offset
FROM g CROSS JOIN ev CROSS JOIN offs o"""


# Cut-offs of the stored versions and of the siblings, 90 days earlier.
VERSION_CUTS = {"2000q4": ("2000-12-31", "2000-10-02"), "2001q1": ("2001-03-31", "2000-12-31")}


def _at(sql: str, day: str) -> str:
    """The same query with its history ending on ``day``."""
    return sql.replace(TRAIN_END_SQL, f"DATE '{day}'")


@oracle("training_flow")
def _():
    parts = []
    for version, (cut, sibling) in VERSION_CUTS.items():
        ev = _at(f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}, {full_forecast_ctes(90)}
  SELECT COUNT(DISTINCT p.shipment_date) AS eval_days,
         round(sum(abs(p.n_shipments - f.y_pred)) / NULLIF(sum(abs(p.n_shipments)), 0), 6) AS eval_wape,
         round(avg(abs(p.n_shipments - f.y_pred)), 6) AS eval_mae,
         round(sqrt(avg(power(p.n_shipments - f.y_pred, 2))), 6) AS eval_rmse
  FROM fc f JOIN panel p ON p.shipment_date = f.shipment_date AND p.entity = f.entity""", sibling)
        own = _at(f"""WITH {panel_ctes()}, {conformal_ctes(calib_lengths_values([60]))}
  SELECT MAX(h.shipment_date) AS data_cutoff, COUNT(DISTINCT h.entity) AS n_entities,
         COUNT(DISTINCT h.shipment_date) AS n_days, round(max(o.lower_offset), 6) AS lower_offset,
         round(max(o.upper_offset), 6) AS upper_offset, round(max(o.coverage), 6) AS coverage
  FROM hist h CROSS JOIN offs o""", cut)
        parts.append(f"SELECT '{version}' AS version, a.*, b.* FROM ({own}) a CROSS JOIN ({ev}) b")
    return " UNION ALL ".join(parts)


@oracle("model_entities")
def _():
    parts = [f"""SELECT '{version}' AS version, entity, COUNT(*) AS n_obs,
       CAST(max_by(n_shipments, shipment_date) AS DOUBLE) AS last_value, round(stddev_samp(diff), 6) AS resid_std
FROM (SELECT *, n_shipments - LAG(n_shipments, 7) OVER (PARTITION BY entity ORDER BY shipment_date) AS diff
      FROM panel WHERE shipment_date <= DATE '{cut}') GROUP BY entity""" for version, (cut, _) in VERSION_CUTS.items()]
    return f"WITH {panel_ctes()} " + " UNION ALL ".join(parts)


@oracle("scoring_by_version")
def _():
    # from the earlier cut-off, the last day asked for is 181 days away
    parts = [_at(f"""SELECT '{version}' AS version, x.* FROM (WITH {panel_ctes()}, {scored_ctes(200)}
SELECT request_id, date, entity, round(point, 6) AS point, round(lower_90, 6) AS lower_90,
       round(upper_90, 6) AS upper_90, round(recommended, 6) AS recommended, alpha_used, cost_ratio_used,
       alpha_source, cost_ratio_source FROM scored) x""", cut) for version, (cut, _) in VERSION_CUTS.items()]
    return " UNION ALL ".join(parts)


@oracle("wape_spread")
def _():
    return _bt("""SELECT model, fold_id, round(max(wape), 6) AS worst_wape, round(min(wape), 6) AS best_wape,
       round(max(wape) / NULLIF(min(wape), 0), 6) AS worst_over_best FROM (
  SELECT model, fold_id, entity, sum(abs(n_shipments - y_pred)) / sum(abs(n_shipments)) AS wape
  FROM bt GROUP BY model, fold_id, entity HAVING sum(abs(n_shipments)) > 0) GROUP BY model, fold_id""")


@oracle("event_gain_ratio")
def _():
    src = (f"SELECT w.event, p.n_shipments, p.ym, p.yb, p.shipment_date FROM paired p "
           f"JOIN ({named_windows_values()}) w ON p.shipment_date BETWEEN w.ws AND w.we "
           f"WHERE p.is_operational = 1")
    a, b = C.EVENT_WINDOWS[0][0], C.EVENT_WINDOWS[1][0]
    return _bt(f"""SELECT cost_ratio, round(max(CASE WHEN event = '{a}' THEN gain_tuned END)
                    / NULLIF(max(CASE WHEN event = '{b}' THEN gain_tuned END), 0), 6) AS gain_ratio
FROM gains GROUP BY cost_ratio""", PAIRED + "," + gain_sql("event", src))


@oracle("fold_spec")
def _():
    rows = ", ".join(f"({f}, {_date(a)}, {_date(b)}, {_date(c)}, '{lbl}')" for f, a, b, c, lbl in C.FOLD_SPEC)
    return _bt(f"""SELECT s.fold_id, s.train_end, s.test_start, s.test_end, s.label,
       split_part(s.label, ': ', 2) AS label_short, d.train_start, d.horizon
FROM (SELECT * FROM (VALUES {rows}) t(fold_id, train_end, test_start, test_end, label)) s
JOIN (SELECT fold_id, MIN(CASE WHEN split = 'train' THEN shipment_date END) AS train_start,
             COUNT(DISTINCT CASE WHEN split = 'test' THEN shipment_date END) AS horizon
      FROM assigned GROUP BY fold_id) d USING (fold_id)""")


@oracle("gain_pivot")
def _():
    src = "SELECT fold_id, n_shipments, ym, yb, shipment_date FROM paired WHERE is_operational = 1"
    cols = ", ".join(
        f"round(max(CASE WHEN fold_id = {f} THEN {expr} END), 6) AS \"{f}_{name}\""
        for f, *_ in C.FOLD_SPEC
        for name, expr in (("tuned", "gain_tuned"), ("raw", "gain_no_tuning"),
                           ("uplift", "gain_tuned - gain_no_tuning")))
    return _bt(f"SELECT cost_ratio, {cols} FROM gains GROUP BY cost_ratio",
               PAIRED + "," + gain_sql("fold_id", src))
