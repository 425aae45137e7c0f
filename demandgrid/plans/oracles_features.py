"""SQL counterparts of profile, features, forecasts and metrics."""

from __future__ import annotations

import math

from .. import constants as k
from .oracles import DASHBOARD, facts, hours

EVENTS = """
ev as (
  select user_id as store_id, (dense_rank() over (order by event_type))::bigint as kind, date_trunc('hour', ts)::timestamp as dt, value,
         event_type from events
),
hourly as (
  select store_id, kind as product_id, dt, sum(value) as sale_amount, max(if(event_type = 'error', 1, 0))::int as hours_stock_status
  from ev group by all
)"""

STATUS = """
base as (select *, list_contains(st, 1)::int as stock_status from facts)"""

SPLIT = """
train as (select * from facts where dt < date '2001-01-01'),
eval as (select * from facts where dt >= date '2001-01-01')"""

W = "(partition by store_id, product_id order by dt)"


def frame(rows: int) -> str:
    return f"(partition by store_id, product_id order by dt rows between {rows - 1} preceding and current row)"


def events(select: str, *more: str) -> str:
    return "with " + ",\n".join([EVENTS, *more]) + "\n" + select


def on_facts(select: str, *more: str) -> str:
    return facts(select, STATUS, *more)


def on_split(select: str, *more: str) -> str:
    return facts(select, SPLIT, *more)


CALENDAR = {
    "hour": "hour(dt)::int", "day_of_week": "(isodow(dt) - 1)::int", "day_of_month": "dayofmonth(dt)::int",
    "month": "month(dt)::int", "quarter": "quarter(dt)::int", "week_of_year": "weekofyear(dt)::int"}
TAU = repr(2 * math.pi)
CYCLES = {f"{c}_{f}": f"round({f}({CALENDAR[c]} * {TAU} / {p}), 6)"
          for c, p in (("hour", 24), ("day_of_week", 7), ("month", 12)) for f in ("sin", "cos")}
WEEK = {"is_weekend": "(isodow(dt) >= 6)::int", "is_weekday": "(isodow(dt) < 6)::int"}
RUSH = {"is_morning_rush": "(hour(dt) between 7 and 9)::int", "is_lunch_time": "(hour(dt) between 11 and 14)::int",
        "is_evening_rush": "(hour(dt) between 17 and 20)::int", "is_late_night": "(hour(dt) >= 22 or hour(dt) <= 5)::int"}
PART = {"day_part": "case when hour(dt) < 6 then 'night' when hour(dt) < 11 then 'morning' when hour(dt) < 17 then 'afternoon' "
                    "when hour(dt) < 22 then 'evening' else 'late' end"}
HOLIDAY = {"is_holiday": "(strftime(dt, '%m-%d') in ('05-27', '06-19'))::int"}


def elapsed(first: str) -> dict[str, str]:
    return {"days_since_start": f"date_diff('hour', {first}, dt::timestamp) // 24",
            "hours_since_start": f"round(date_diff('second', {first}, dt::timestamp) / 3600, 6)"}


FOURIER = {f"fourier_{f}_{p}_{j}": f"round({f}({TAU} * {j} / {p} * t), 6)"
           for j in (1, 2, 3) for p in k.FOURIER_PERIODS for f in ("sin", "cos")}
LAGS = {f"sale_amount_lag_{n}": f"lag(sale_amount, {n}) over {W}" for n in k.LAG_PERIODS}
STOCK_LAGS = {f"stockout_lag_{n}": f"lag(stock_status::double, {n}) over {W}" for n in (1, 2, 3, 7)}
MEANS = {f"sale_amount_rolling_mean_{n}": f"round(avg(sale_amount) over {frame(n)}, 6)" for n in k.ROLLING_WINDOWS}
STDS = {f"sale_amount_rolling_std_{n}": f"round(coalesce(stddev_samp(sale_amount) over {frame(n)}, 0), 6)" for n in k.ROLLING_WINDOWS}
MAXES = {f"sale_amount_rolling_max_{n}": f"max(sale_amount) over {frame(n)}" for n in k.ROLLING_WINDOWS}
MEDIANS = {f"sale_amount_rolling_median_{n}": f"quantile_cont(sale_amount, 0.5) over {frame(n)}" for n in k.ROLLING_WINDOWS}
RATIO = {"stockout_ratio_7h": f"round(avg(stock_status) over {frame(7)}, 6)"}


def cols(*groups: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for g in groups for name, sql in g.items())


def half_even(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


STORE_STATS = f"""
store_stats as (
  select store_id, {half_even('avg(sale_amount)')} as store_avg_sales, {half_even('stddev_samp(sale_amount)')} as store_sales_volatility,
         {half_even('max(sale_amount)')} as store_max_sales, count(distinct product_id) as store_product_count from base group by 1
)"""
PRODUCT_STATS = f"""
product_stats as (
  select product_id, {half_even('avg(sale_amount)')} as product_avg_sales,
         {half_even('stddev_samp(sale_amount)')} as product_sales_volatility, count(distinct store_id) as product_store_count
  from base group by 1
)"""
UNMET = "(stock_status = 1 and sale_amount = 0 and coalesce(sale_amount_lag_1, 0) > 0)::int as unmet_demand"
INTERACTIONS = """round(avg_temperature * hour, 6) as temp_hour_interaction, precpt * is_weekend as rain_weekend_interaction,
  discount * is_weekend as discount_weekend, discount * is_evening_rush as discount_evening,
  stock_status * hour as stock_hour_interaction"""
FIRST = "(select min(dt)::timestamp from {})"
KEYS = "store_id, product_id, dt"

ALL_FEATURES = f"""
ft0 as (
  select *, row_number() over {W} - 1 as t, {cols(CALENDAR, CYCLES, WEEK, RUSH, PART, HOLIDAY, elapsed(FIRST.format('base')), LAGS, STOCK_LAGS, MEANS, STDS, MAXES, MEDIANS, RATIO)}
  from base
),
ft as (
  select ft0.* exclude (t, sold, st, stock_status), {cols(FOURIER)}, {UNMET}, {INTERACTIONS},
         store_stats.* exclude (store_id), product_stats.* exclude (product_id)
  from ft0 join store_stats using (store_id) join product_stats using (product_id)
)"""

NAIVE = """
ranked as (select *, row_number() over (partition by store_id, product_id order by dt) as up,
                  row_number() over (partition by store_id, product_id order by dt desc) as back,
                  count(*) over (partition by store_id, product_id) as n from train),
fits as (
  select store_id, product_id, max(sale_amount) filter (back = 1) as last_value, avg(sale_amount) filter (back <= 24) as seasonal,
         avg(sale_amount) as mean, max(sale_amount) filter (up = 1) as first_value, max(n) as n from ranked group by 1, 2
),
preds as (
  select e.store_id, e.product_id, e.city_id, e.holiday_flag, e.dt, e.sale_amount as y,
         greatest(0, coalesce(last_value, 0)) as p_last, greatest(0, coalesce(seasonal, 0)) as p_seasonal,
         greatest(0, coalesce(mean, 0)) as p_mean,
         greatest(0, coalesce(last_value + if(n > 1, (last_value - first_value) / (n - 1), 0), 0)) as p_drift
  from eval e left join fits using (store_id, product_id)
),
scores as (select *, p_drift as p from preds),
steps as (select abs(sale_amount - lag(sale_amount, 1) over (partition by store_id, product_id order by dt)) as d from train)"""

METRICS = {
    "MAE": "avg(abs(y - p))", "RMSE": "sqrt(avg(power(y - p, 2)))", "MAPE": "avg(abs((y - p) / greatest(abs(y), 1e-8))) * 100",
    "sMAPE": "avg(abs(y - p) / ((abs(y) + abs(p)) / 2 + 1e-8)) * 100", "Bias": "avg(p - y)",
    "Bias_Percentage": "avg(p - y) / (avg(y) + 1e-8) * 100", "MASE": "avg(abs(y - p)) / ((select avg(d) from steps) + 1e-8)"}


def metric(name: str) -> str:
    return f'round({METRICS[name]}, {0 if name == "MAPE" else 6}) as "{name}"'


def naive(strategy: str) -> str:
    return on_split(f"select store_id, product_id, dt, round(p_{strategy}, 6) as prediction from preds", NAIVE)


CELLS = """
placed as (select *, row_number() over (partition by store_id, product_id order by dt) - 1 as place from hourly
           where dt < timestamp '2024-01-20'),
cells as (select store_id, product_id, (place % 24)::int as idx, avg(sale_amount) as value from placed group by 1, 2, 3)"""

SEASONAL = events("""
select h.store_id, h.product_id, h.dt, round(greatest(0, coalesce(value, 0)), 6) as prediction
from (select * from hourly where dt >= timestamp '2024-01-20') h left join cells c
     on h.store_id = c.store_id and h.product_id = c.product_id and hour(h.dt) = c.idx""", CELLS)

LAGGED = ",\n".join(f"""{side}_lags as (select store_id, product_id, dt, {cols(LAGS)} from {side})""" for side in ("train", "eval"))
SCALED = ["avg_temperature", "precpt", "discount", "sale_amount"]


def scaled(centre: str, spread: str) -> str:
    """Evaluation rows scaled by values of the training rows."""
    fit = ", ".join(f'{centre.format(c)} as "c_{c}", {spread.format(c)} as "s_{c}"' for c in SCALED)
    out = ", ".join(f'round(("{c}" - "c_{c}") / coalesce(nullif("s_{c}", 0), 1), 6) as "{c}"' for c in SCALED)
    return on_split(f"select store_id, product_id, dt, {out} from eval, (select {fit} from train)")


LINE = "line as (select regr_slope(sale_amount, discount) as slope, regr_intercept(sale_amount, discount) as icpt from train)"
LINE_FORECAST = on_split("""select store_id, product_id, dt, round(greatest(0, slope * discount + icpt), 6) as prediction
    from eval, line""", LINE)

MEASURES = """num_products num_days_tracked observed_hours total_units units_per_hour active_hours units_per_active_hour
    stockout_hours stock_availability_rate active_hour_ratio units_per_day promo_share promo_units non_promo_units sales_cv
    avg_weekend_units avg_weekday_units weekend_weekday_ratio""".split()
# the dashboard without rounding, as scaling must not see rounded values
EXACT_DASHBOARD = """
exact as (
  select store_id, num_products, num_days_tracked, observed_hours, total_units, total_units / observed_hours as units_per_hour,
         active_hours, total_units / nullif(active_hours, 0) as units_per_active_hour, stockout_hours,
         1 - stockout_hours / observed_hours as stock_availability_rate, active_hours / observed_hours as active_hour_ratio,
         total_units / nullif(num_days_tracked, 0) as units_per_day, promo_units / nullif(total_units, 0) as promo_share,
         promo_units, non_promo_units, sd / nullif(mean, 0) as sales_cv, we as avg_weekend_units, wd as avg_weekday_units,
         we / nullif(wd, 0) as weekend_weekday_ratio from dash
)"""


def z_score(c: str) -> str:
    return f'coalesce(("{c}" - avg("{c}") over ()) / coalesce(nullif(stddev_pop("{c}") over (), 0), 1), 0)'


def settled(c: str) -> str:
    """A constant column has z-score 0, whatever its deviation rounds to."""
    return f'round(if(max("{c}") over () = min("{c}") over (), 0, {z_score(c)}), 6) as "{c}"'


def settled_z(c: str) -> str:
    return f'if(max("{c}") over () = min("{c}") over (), 0, {z_score(c)})'


Z = f"""
z as (select store_id, [{', '.join(map(settled_z, MEASURES))}]::double[] as m from exact)"""
HEALTH = Z + f""",
centres as (select store_id % 4 as g, [{', '.join(f'avg(m[{i + 1}])' for i in range(len(MEASURES)))}] as c from z group by 1),
health as (select store_id, -min(sqrt(list_sum(list_transform(list_zip(m, c), lambda x: power(x[1] - x[2], 2))))) as score from z, centres group by 1)"""

#: Eigenvalues of the covariance matrix of all measures by Jacobi rotations, one pair of measures after the other.
PAIRS = [(i, j) for i in range(1, len(MEASURES) + 1) for j in range(i + 1, len(MEASURES) + 1)]
ROTATED = f"""
covariance as (select [{', '.join('[' + ', '.join(f'avg(m[{i + 1}] * m[{j + 1}])' for j in range(len(MEASURES))) + ']' for i in range(len(MEASURES)))}] as a from z),
pairs as (select {[list(p) for p in PAIRS]} as pq),
turns as (
  select 0 as k, a from covariance
  union all
  select k + 1, if(a[p][q] = 0, a, list_transform(half, lambda row, i: if(i = p, list_transform(list_zip(half[p], half[q]), lambda x: c * x[1] - s * x[2]),
      if(i = q, list_transform(list_zip(half[p], half[q]), lambda x: s * x[1] + c * x[2]), row))))
  from (select *, list_transform(a, lambda row: list_transform(row, lambda x, j: if(j = p, c * row[p] - s * row[q], if(j = q, s * row[p] + c * row[q], x)))) as half
        from (select *, t / sqrt(1 + t * t) as s, 1 / sqrt(1 + t * t) as c
              from (select *, if(a[p][q] = 0, 0, if(tau < 0, -1, 1) / (abs(tau) + sqrt(1 + tau * tau))) as t
                    from (select *, if(a[p][q] = 0, 0, (a[q][q] - a[p][p]) / (2 * a[p][q])) as tau
                          from (select k, a, pq[k % {len(PAIRS)} + 1][1] as p, pq[k % {len(PAIRS)} + 1][2] as q from turns, pairs)))))
  where k < {12 * len(PAIRS)}
),
eigen as (select unnest(list_transform(range(1, {len(MEASURES) + 1}), lambda i: a[i][i])) as v from turns where k = {12 * len(PAIRS)}),
parts as (select (row_number() over (order by v desc))::int as component, v / sum(v) over () as share from eigen),
summed as (select *, sum(share) over (order by component) as cumulative from parts)"""


def on_stores(select: str, *more: str) -> str:
    return hours(select, DASHBOARD, EXACT_DASHBOARD, *more)


COLUMNS = """city_id store_id management_group_id first_category_id second_category_id third_category_id product_id dt sale_amount hours_sale
    stock_hour6_22_cnt hours_stock_status discount holiday_flag activity_flag precpt avg_temperature avg_humidity avg_wind_level""".split()


def run_metrics(side: str, names: tuple[str, ...]) -> str:
    return ", ".join(f'round({METRICS[n]}, 6) as "{side}_{n}"' for n in names)


# forecasts of both sets by the two kinds of naive runs that the results table holds
RUNS = """
runs as (
  select 'mean' as name, 'train' as side, sale_amount as y, mean as p from train join fits using (store_id, product_id)
  union all select 'naive', 'train', sale_amount, seasonal from train join fits using (store_id, product_id)
  union all select 'mean', 'eval', y, p_mean from preds union all select 'naive', 'eval', y, p_seasonal from preds
)"""
RUN_METRICS = ("MAE", "RMSE", "sMAPE", "Bias")

FITS = on_split("select count(*) as n_rows, 0::bigint as n_missing, 0::bigint as n_negative, 1 as beats_mean from eval")

FEATURE_ORACLES: dict[str, str] = {
    **{f"ml_{name}": FITS for name in ("tree", "forest", "gbt", "boost_cols")},
    "ml_importance": "select 1.0::double as total, 0::bigint as n_negative, 1 as one_per_feature",
    "snk_results": on_split(f"""select 'baseline_' || t.name as experiment, t.name as model_name, 0::bigint as n_features,
        t.n as n_train_samples, e.n as n_eval_samples, t.* exclude (name, n), e.* exclude (name, n)
        from (select name, count(*) as n, {run_metrics('train', RUN_METRICS)} from runs where side = 'train' group by 1) t
        join (select name, count(*) as n, {run_metrics('eval', (*RUN_METRICS, 'MASE'))} from runs where side = 'eval' group by 1) e using (name)""", NAIVE, RUNS),
    "snk_segments": on_stores("select store_id, round(total_units, 6) as total_units, 1 as has_cluster, 1 as has_name, 1 as has_index from exact"),
    "seg_pca": on_stores("""select component, round(greatest(share, 0), 6) as share, round(cumulative, 6) as cumulative,
        component <= (select min(component) from summed where cumulative >= 0.9 - 1e-12) as kept from summed""", Z, ROTATED).replace("with ", "with recursive ", 1),
    "seg_pca_two": on_stores("""select i::int as component, round((1 + if(i = 1, 1, -1) * abs(corr(total_units, sales_cv))) / 2, 6) as share,
        round(if(i = 1, (1 + abs(corr(total_units, sales_cv))) / 2, 1), 6) as cumulative from exact cross join (values (1), (2)) as v(i) group by i"""),
    "seg_pca_full": "select 18::bigint as n_components, 1.0::double as total, 1 as first_is_kept, 1 as share_is_reached",
    "seg_kmeans": on_stores("select count(*) as n_stores, 4::bigint as n_clusters, 0::bigint as n_misplaced from exact"),
    "seg_sweep": "select i::int as k, 1 as has_inertia, 1 as has_silhouette from range(2, 11) as r(i)",
    "src_load": on_split("""select 'train' as split, count(*) as n_rows, min(dt) as first_dt, max(dt) as last_dt from train
        union all select 'eval', count(*), min(dt), max(dt) from eval"""),
    "src_sample_frac": facts("""select store_id, product_id, dt, sale_amount from facts
        where substr(md5('42|' || store_id || '|' || product_id || '|' || dt), 1, 8) < '19999999'"""),
    "src_sample_n": facts("""select store_id, product_id, dt, sale_amount from facts
        order by md5('42|' || store_id || '|' || product_id || '|' || dt) limit 20000"""),
    "src_views": hours("""select store_id, sum(v) as units, count(*) filter (h between 6 and 22 and stock_hour6_22_cnt > 0) as risk_hours
        from hours group by 1"""),
    "vec_parse": facts("select store_id, product_id, dt, sold::double[] as sale_values, st::int[] as status_values from facts"),
    "vec_unnest_ord": hours("""select store_id, h + 1 as hour_index, sum(v) as total, count(*) as n from hours group by 1, 2"""),
    "vec_zip_explode": facts("""select store_id, product_id, sale_amount_hour, stock_status_hour, count(*) as n from
        (select store_id, product_id, (unnest(sold))::double as sale_amount_hour, (unnest(st))::int as stock_status_hour from facts)
        group by all"""),
    "vec_hour_index": facts("""select product_id, hour, count(*) as n, min(sale_amount_hour) as low, max(sale_amount_hour) as high from
        (select product_id, (unnest(sold))::double as sale_amount_hour, unnest(range(24))::int as hour from facts) group by all"""),
    "vec_rename": facts("""select store_id, hour, sum(sale_amount_hour) as sale_amount_hour, sum(stock_status_hour)::bigint as stock_status_hour from
        (select store_id, (unnest(sold))::double as sale_amount_hour, unnest(st) as stock_status_hour, unnest(range(24))::int as hour from facts)
        group by all"""),
    "prof_shape_span": facts("""select count(*) as n_rows, 19 as n_columns, min(dt) as start_dt, max(dt) as end_dt,
        (max(dt) - min(dt))::int as duration_days from facts"""),
    "prof_dimensions": facts("""select count(distinct store_id) as unique_stores, count(distinct product_id) as unique_products,
        count(distinct city_id) as unique_cities, count(distinct (store_id, product_id)) as store_product_combinations from facts"""),
    "prof_target": facts("""select round(avg(sale_amount), 6) as mean_sales, median(sale_amount) as median_sales,
        round(avg((sale_amount = 0)::int) * 100, 6) as zero_sales_percentage, max(sale_amount) as max_sales from facts"""),
    "prof_stockout": hours("""select count(*) as total_observations, count(*) filter (v = 0) as stockout_hours,
        round(count(*) filter (v = 0) / count(*) * 100, 6) as stockout_rate_percent,
        count(distinct store_id) filter (v = 0) as stores_with_stockouts from hours"""),
    "prof_missing": on_facts(f"""select column_name, n_missing from (
        select {', '.join(f'count(*) - count("{c}") as "{c}"' for c in [*COLUMNS, *LAGS])} from l
        ) unpivot (n_missing for column_name in ({', '.join([*COLUMNS, *LAGS])}))""",
        f"l as (select *, {cols(LAGS)} from base)"),
    "prof_duplicates": facts(f"""select (sum(c) - count(*))::bigint as duplicate_rows from (select count(*) as c from
        (select {', '.join(COLUMNS)} from facts union all select {', '.join(COLUMNS)} from facts where store_id % 7 = 0) group by {', '.join(COLUMNS)})"""),
    "val_input": on_facts(f"""
        select column_name, n_rows, n_missing, round(n_missing / n_rows, 6) as missing_share, if(column_name = 'amount_per_rain', dry, 0) as n_infinite,
               case when column_name = 'amount_per_rain' and dry > 0 then 'infinite values'
                    when column_name = 'sale_amount' and n_missing > 0 then 'target has missing values'
                    when n_missing / n_rows > 0.5 then 'mostly missing' else 'ok' end as finding
        from (select count(*) as n_rows, count(*) filter (precpt = 0) as dry, 0::bigint as amount_per_rain,
                     {', '.join(f'count(*) - count("{c}") as "{c}"' for c in [*COLUMNS, *LAGS])} from l)
             unpivot (n_missing for column_name in (amount_per_rain, {', '.join([*COLUMNS, *LAGS])}))""",
        f"l as (select *, {cols(LAGS)} from base)"),
    "val_drop_all_null": facts(f"select {KEYS}, lag(sale_amount, 1) over {W} as sale_amount_lag_1 from facts"),
    "val_numeric_only": facts("select * exclude (sold, st, hours_sale, hours_stock_status) from facts"),
    "ft_calendar": events(f"select {KEYS}, {cols(CALENDAR)} from hourly"),
    "ft_cyclical": events(f"select {KEYS}, {cols(CYCLES)} from hourly"),
    "ft_weekpart": events(f"select {KEYS}, {cols(WEEK)} from hourly"),
    "ft_rush": events(f"select {KEYS}, {cols(RUSH)} from hourly"),
    "ft_day_part": events(f"select {KEYS}, {cols(PART)} from hourly"),
    "ft_holiday": facts(f"select {KEYS}, {cols(HOLIDAY)} from facts"),
    "ft_elapsed": events(f"select {KEYS}, {cols(elapsed(FIRST.format('hourly')))} from hourly"),
    "ft_fourier": facts(f"select {KEYS}, {cols(FOURIER)} from (select *, row_number() over {W} - 1 as t from facts)"),
    "ft_fourier_global": facts(f"""select {KEYS}, {cols(FOURIER)} from
        (select *, row_number() over (order by store_id, product_id, dt) - 1 as t from facts)"""),
    "ft_store_stats": on_facts(f"select b.store_id, b.product_id, b.dt, s.* exclude (store_id) from base b join store_stats s using (store_id)", STORE_STATS),
    "ft_product_stats": on_facts(f"select b.store_id, b.product_id, b.dt, s.* exclude (product_id) from base b join product_stats s using (product_id)", PRODUCT_STATS),
    "ft_stock_coerce": facts(f"select {KEYS}, 0 as coerced, list_contains(st, 1)::int as stock_status from facts"),
    "ft_lag": facts(f"select {KEYS}, {cols(LAGS)} from facts"),
    "ft_stockout_lag": on_facts(f"select {KEYS}, {cols(STOCK_LAGS)} from base"),
    "ft_unmet_demand": on_facts(f"select {KEYS}, {UNMET} from (select *, lag(sale_amount) over {W} as sale_amount_lag_1 from base)"),
    "ft_roll_mean": facts(f"select {KEYS}, {cols(MEANS)} from facts"),
    "ft_roll_std": facts(f"select {KEYS}, {cols(STDS)} from facts"),
    "ft_roll_max": facts(f"select {KEYS}, {cols(MAXES)} from facts"),
    "ft_roll_median": facts(f"select {KEYS}, {cols(MEDIANS)} from facts"),
    "ft_stock_ratio": on_facts(f"select {KEYS}, {cols(RATIO)} from base"),
    "ft_interactions": on_facts(f"select {KEYS}, {INTERACTIONS} from (select *, {cols(CALENDAR, WEEK, RUSH)} from base)"),
    "ft_all": on_facts("select * from ft", STORE_STATS, PRODUCT_STATS, ALL_FEATURES),
    "fc_last": naive("last"),
    "fc_seasonal_mean": naive("seasonal"),
    "fc_mean": naive("mean"),
    "fc_drift": naive("drift"),
    "fc_apply": on_split("select store_id, product_id, dt, round(p_mean, 6) as prediction, (n is null)::int as is_new from preds left join fits using (store_id, product_id)", NAIVE),
    "fc_seasonal_naive": SEASONAL,
    **{f"ev_{key}": on_split(f"select {metric(name)} from scores", NAIVE) for key, name in
       (("mae", "MAE"), ("rmse", "RMSE"), ("mape", "MAPE"), ("smape", "sMAPE"), ("bias", "Bias"), ("bias_pct", "Bias_Percentage"),
        ("mase", "MASE"))},
    "ev_all": on_split("select " + ", ".join(map(metric, METRICS)) + " from scores", NAIVE),
    "ev_by_group": on_split("select city_id, holiday_flag, " + ", ".join(map(metric, METRICS))
                            + ", count(*) as n_observations from scores group by 1, 2", NAIVE),
    "ml_impute": on_split("select store_id, product_id, dt, " + ", ".join(
        f'coalesce("{c}", (select median("{c}") from train_lags)) as "{c}"' for c in LAGS) + " from eval_lags", LAGGED),
    "ml_scale_standard": scaled('avg("{0}")', 'stddev_pop("{0}")'),
    "ml_scale_robust": scaled('quantile_cont("{0}", 0.5)', '(quantile_cont("{0}", 0.75) - quantile_cont("{0}", 0.25))'),
    "ml_finite": facts("""select store_id, product_id, dt, (case when precpt = 0 and sale_amount = 0 then 0 when precpt = 0 then 1e10
        when sale_amount = 0 then -1e10 else sale_amount end)::double as x from facts"""),
    "ml_predict": LINE_FORECAST,
    "ml_r2": on_split("select count(*) as n_samples, round(regr_r2(sale_amount, discount), 6) as train_r2 from train"),
    "ml_coefficients": on_split("""select 'discount' as feature, round(slope, 6) as coefficient from line
        union all select 'intercept', round(icpt, 6) from line""", LINE),
    "ml_importance_detail": facts("""select rnk::int as rnk, feature, importance, round(sum(importance) filter (rnk <= 5) over () / sum(importance) over (), 6) as top_5_share,
        round(sum(importance) filter (rnk <= 10) over () / sum(importance) over (), 6) as top_10_share
        from (select 'product_' || product_id as feature, sum(sale_amount) as importance,
                     row_number() over (order by sum(sale_amount) desc, 'product_' || product_id) as rnk from facts group by product_id)
        qualify rnk <= 10"""),
    "snk_model": LINE_FORECAST,
    "seg_scale": on_stores("select store_id, " + ", ".join(map(settled, MEASURES)) + " from exact"),
    "seg_health": on_stores("select store_id, round(score, 6) as health_score from health", HEALTH),
    "seg_index": on_stores("""select store_id, round(100 * (score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0), 6)
        as health_index from health""", HEALTH),
    "seg_names": on_stores("""select store_id, total_units, store_id % 4 as health_cluster, name as cluster_name from exact join
        (select g, ['Struggling Stores', 'Stable but Low Performers', 'Mid-Tier Performers', 'High Performers'][row_number() over (order by m, g)] as name
         from (select store_id % 4 as g, avg(total_units) as m from exact group by 1)) on store_id % 4 = g"""),
}
