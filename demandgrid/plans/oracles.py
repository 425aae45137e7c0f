"""Independent SQL for every query that SQL can express, run by DuckDB on the same tables.

The SQL computes from the exploded hourly rows throughout and shares no shortcut with the Spark side.
"""

from __future__ import annotations

FACTS = """
daily as (
  select s.s_nationkey::bigint as city_id, l.l_suppkey as store_id, n.n_regionkey::bigint as management_group_id,
         cast(split_part(p.p_brand, '#', 2) as bigint) as product_id, cast(l.l_shipdate as date) as dt,
         cast(sum(case when l.l_returnflag = 'R' then 0 else l.l_quantity end) as bigint) as q,
         min(l.l_discount) as low
  from lineitem l join part p on l.l_partkey = p.p_partkey join supplier s on l.l_suppkey = s.s_suppkey
       join nation n on s.s_nationkey = n.n_nationkey
  group by all
),
dated as (select *, date_diff('day', date '1995-01-01', dt) as dn from daily),
slots as (
  select *, list_transform(range(24), lambda h: q // 24 + (case when (h + store_id) % 24 < q % 24 then 1 else 0 end)) as sold,
         list_transform(range(24), lambda h: case when (store_id * 7 + product_id * 3 + dn + h * h) % 4 = 0 then 1 else 0 end) as st
  from dated
),
facts as (
  select city_id, store_id, management_group_id, product_id % 5 as first_category_id, product_id % 10 as second_category_id,
         product_id as third_category_id, product_id, dt, q::double as sale_amount,
         '[' || array_to_string(sold, ' ') || ']' as hours_sale,
         list_sum(st[7:23])::int as stock_hour6_22_cnt,
         '[' || array_to_string(st, ' ') || ']' as hours_stock_status,
         round(1 - 3 * low, 2) as discount, (case when dn % 10 = 0 then 1 else 0 end)::int as holiday_flag,
         (case when q > 0 then 1 else 0 end)::int as activity_flag,
         greatest(0, (dn * 37 + city_id) % 10 - 5) / 2.0::double as precpt, (dn % 36)::double as avg_temperature,
         (40 + dn % 50)::double as avg_humidity, (dn % 7)::double as avg_wind_level, sold, st
  from slots
)"""

HOURS = FACTS + """,
hours as (
  select *, (unnest(st))::double as v, (unnest(range(24)))::int as h, dayofweek(dt)::int as dow, month(dt)::int as mon,
         (case when dayofweek(dt) in (0, 6) then 1 else 0 end)::int as wknd,
         (case when discount > 0 then 1 else 0 end)::int as promo
  from facts
)"""


def facts(select: str, *more: str) -> str:
    return "with " + ",\n".join([FACTS, *more]) + "\n" + select


def hours(select: str, *more: str) -> str:
    return "with " + ",\n".join([HOURS, *more]) + "\n" + select


CATEGORY = "first_category_id, second_category_id, third_category_id"

DASHBOARD = """
dash as (
  select store_id, count(distinct product_id) as num_products, count(distinct dt) as num_days_tracked,
         count(*) as observed_hours, sum(sale_amount) as total_units,
         count(*) filter (sale_amount > 0) as active_hours, count(*) filter (sale_amount = 0) as stockout_hours,
         coalesce(sum(sale_amount) filter (promo = 1), 0) as promo_units,
         coalesce(sum(sale_amount) filter (promo = 0), 0) as non_promo_units,
         stddev_samp(sale_amount) as sd, avg(sale_amount) as mean,
         avg(if(wknd = 1, sale_amount, 0)) as we, avg(if(dow between 1 and 5, sale_amount, 0)) as wd
  from hours group by store_id
),
dashboard as (
  select store_id, num_products, num_days_tracked, observed_hours, total_units,
         round(total_units / observed_hours, 6) as units_per_hour, active_hours,
         round(total_units / nullif(active_hours, 0), 6) as units_per_active_hour, stockout_hours,
         round(1 - stockout_hours / observed_hours, 6) as stock_availability_rate,
         round(active_hours / observed_hours, 6) as active_hour_ratio,
         round(total_units / nullif(num_days_tracked, 0), 6) as units_per_day,
         round(promo_units / nullif(total_units, 0), 6) as promo_share, promo_units, non_promo_units,
         round(sd / nullif(mean, 0), 6) as sales_cv, round(we, 6) as avg_weekend_units, round(wd, 6) as avg_weekday_units,
         round(we / nullif(wd, 0), 6) as weekend_weekday_ratio
  from dash
)"""

INTEL = """
cats as (
  select first_category_id, second_category_id, third_category_id, promo as promo_flag,
         count(distinct store_id) as num_stores, count(distinct product_id) as num_products, sum(sale_amount) as toal_units,
         coalesce(sum(sale_amount) filter (promo = 1), 0) as promo_units,
         coalesce(sum(sale_amount) filter (promo = 0), 0) as non_promo_units, count(*) as observed_hours,
         stddev_samp(sale_amount) as sales_volatility, count(*) filter (v = 0) as stockout_hours,
         avg(v) filter (v > 0) as pos, avg(v) filter (precpt > 0) as wet,
         avg(if(holiday_flag = 1, sale_amount, 0)) as hol, avg(if(holiday_flag = 0, sale_amount, 0)) as nohol,
         avg(v) filter (wknd = 1) as we, avg(v) filter (wknd = 0) as wd,
         stddev_samp(if(holiday_flag = 1, v, 0)) as sdh, stddev_samp(if(holiday_flag = 0, v, 0)) as sdn
  from hours group by all
),
intel as (
  select first_category_id, second_category_id, third_category_id, promo_flag, num_stores, num_products, toal_units,
         promo_units, non_promo_units, round(promo_units / nullif(non_promo_units, 0), 6) as promo_lift_index, observed_hours,
         round(toal_units / observed_hours, 6) as avg_units_per_hour, round(sales_volatility, 6) as sales_volatility,
         stockout_hours, round(toal_units / num_stores, 6) as units_per_store,
         round(1 - stockout_hours / observed_hours, 6) as stock_availability_rate,
         round(coalesce(pos * nullif(stockout_hours, 0), 0), 6) as lost_units_due_to_stockouts,
         round(wet, 6) as avg_units_when_precip_is_more_than_zero, round(hol, 6) as avg_units_on_holidays,
         round(nohol, 6) as avg_units_non_holidays, round(hol / nullif(nohol, 0), 6) as holiday_lift_index,
         round(we / nullif(wd, 0), 6) as weekend_weekday_ratio,
         round(sdh / nullif(sdn, 0), 6) as holiday_vs_nonholiday_variability
  from cats
)"""

RHYTHM = """
beat as (
  select h as hour_of_day, dow as day_of_week, wknd as is_weekend, mon as months, holiday_flag, promo as promo_flag,
         sum(v) as total_units, avg(v) as mean, count(*) filter (v = 0) as stockout_hours, count(*) as n,
         count(distinct store_id) as num_active_stores, avg(precpt) as rain
  from hours group by all
),
rhythm as (
  select hour_of_day, day_of_week, is_weekend, months, holiday_flag, promo_flag, total_units,
         round(mean, 6) as avg_units_per_hour, stockout_hours, round(1 - stockout_hours / n, 6) as stock_availability_rate,
         num_active_stores, round(total_units / nullif(num_active_stores, 0), 6) as store_load_index,
         round(rain, 6) as avg_precip,
         case when mean > 1.2 * (select avg(mean) from beat) then 'High Intensity'
              when mean < 0.8 * (select avg(mean) from beat) then 'Low Intensity' else 'Medium Intensity' end as performance_class
  from beat
)"""

SUMMARY = """
select city_id, store_id, product_id, holiday_flag, precpt, discount, dt, mon as "month", dow as day_of_week,
       wknd as is_weekend, (case when h <= 5 then 1 when h <= 11 then 2 when h <= 15 then 3 when h <= 19 then 4 else 5 end)::int as part_of_day,
       promo as promo_flag, (case when precpt > 0 then 1 else 0 end)::int as is_rainy, (case when v > 0 then 1 else 0 end)::int as activity_flag,
       (case when h between 6 and 22 and stock_hour6_22_cnt > 0 then 1 else 0 end)::int as stockout_risk_hour,
       v as sale_amount_hour, h as hour_of_day
from hours"""

ORACLES: dict[str, str] = {
    "view_hourly_summary": hours(SUMMARY),
    "view_store_dashboard": hours("select * from dashboard", DASHBOARD),
    "view_category_intel": hours("select * from intel", INTEL),
    "view_rhythm_agg": hours("select * exclude (performance_class) from rhythm", RHYTHM),
    "view_rhythm_patterns": hours("select * from rhythm", RHYTHM),
    "q01": facts("select count(distinct store_id) as num_stores, count(distinct city_id) as num_cities from facts"),
    "q02": facts("select max(dt) as last_dt, min(dt) as first_dt from facts"),
    "q03": facts("""select count(distinct product_id) as num_products, count(distinct first_category_id) as num_first_category_ids,
        count(distinct second_category_id) as num_second_category_ids,
        count(distinct third_category_id) as num_third_category_ids from facts"""),
    "q04": facts("select sum(sale_amount) as total_sales from facts"),
    "q05": facts("select round(sum(sale_amount) / (count(*) * 24), 6) as avg_sales_per_hour from facts"),
    "q06": facts("""select count(*) filter (stock_hour6_22_cnt = 0) as zero_sales,
        count(*) filter (stock_hour6_22_cnt > 0) as non_zero_sales from facts"""),
    "q07": hours("select h + 1 as hour_of_day, sum(v) as total_sales from hours group by h order by h"),
    "q08": facts("select dayofweek(dt)::int as weekday, sum(sale_amount) as total_sales from facts group by 1"),
    "q09": facts("select holiday_flag, round(avg(sale_amount), 6) as avgsales from facts group by 1"),
    "q10": facts("select (precpt > 0)::int as is_rainy, round(avg(sale_amount), 6) as avg_sales from facts group by 1"),
    "t3a": hours("select city_id, sum(v) as total_units from hours where wknd = 1 and promo = 1 group by 1"),
    "t3c": hours(f"select {CATEGORY} from intel where stock_availability_rate < 0.2 and holiday_lift_index > 1.2", INTEL),
    "t3c_wide": hours(f"select {CATEGORY} from intel where stock_availability_rate < 0.9 and holiday_lift_index > 0.11", INTEL),
    "t3d": hours("""select hour_of_day, day_of_week, is_weekend, holiday_flag, promo_flag, avg_units_per_hour, total_units,
        num_active_stores, store_load_index, performance_class from rhythm where performance_class = 'High Intensity'
        order by avg_units_per_hour desc""", RHYTHM),
    "q11": hours("select round(stockout_hours / observed_hours, 6) as total_hours_experienced_stockouts from dashboard", DASHBOARD),
    "q12": hours("""select 'Hours_where_sales_more_than_zero' as sales, round(avg(v), 6) as average from hours where v > 0
        union all select 'Hours_where_sales_equal_to_zero', avg(v) from hours where v = 0"""),
    "q13": hours("""select product, round(stockout_rate, 6) as stockout_rate, (dense_rank() over (order by stockout_rate desc))::int as rnk
        from (select product_id as product, count(*) filter (v = 0) / count(*) as stockout_rate from hours group by 1)
        order by rnk, product limit 10"""),
    "q14": hours("""select h as hour_of_day, round(count(*) filter (v = 0 and v > 0) / count(*), 6) as stockout_rate_by_hour
        from hours group by h"""),
    "q15": hours("""select store_id, stockout_hours, observed_hours, stock_availability_rate from dashboard
        order by stockout_hours desc, store_id limit 5""", DASHBOARD),
    "q16": hours("select store_id, total_units from dashboard order by total_units desc, store_id limit 10", DASHBOARD),
    "q17": hours("""select city_id, round(avg(u), 6) as avg_store_units
        from (select city_id, store_id, sum(v) as u from hours group by 1, 2) group by 1 order by 2 desc"""),
    "q18": hours("""select store_id, total_units, round(stockout_hours / observed_hours, 6) as stockout_share,
        stock_availability_rate from dashboard""", DASHBOARD),
    "q19": hours(f"select {CATEGORY}, toal_units from intel order by toal_units desc, {CATEGORY}, promo_flag limit 10", INTEL),
    "q20": hours("""select product_id, round(sales, 6) as sales, (dense_rank() over (order by sales desc))::int as rnk
        from (select product_id, avg(v) as sales from hours group by 1)"""),
    "q21": hours("select promo as promo_flag, round(avg(v), 6) as avg_sales from hours group by 1"),
    "q22": hours("""select sum(v) as sums, case when discount = 1 then '0% (No discount)'
        when discount > 0.9 and discount < 0.99 then '1–10%' when discount <= 0.8 then '11–20%' else '21%+' end as ranges
        from hours group by 2"""),
    "q23": hours(f"""select {CATEGORY}, promo_units, non_promo_units, toal_units from intel
        order by toal_units desc, {CATEGORY}, promo_flag limit 10""", INTEL),
    "q24": hours("select (v > 0)::int as activity_flag, round(avg(v), 6) as avg_sales from hours group by 1"),
    "q25": hours("select promo as promo_flag, round(avg(v), 6) as avg_sales from hours group by promo"),
    "q26": hours("""select store_id, product_id, round(pos, 6) as avg_in_stock_sales, round(zero / n, 6) as stockout_rate
        from (select store_id, product_id, avg(v) filter (v > 0) as pos, count(*) filter (v = 0) as zero, count(*) as n
              from hours group by 1, 2) order by pos desc nulls first, store_id, product_id limit 5"""),
    "q26_sales": facts("""select store_id, product_id, round(pos, 6) as avg_in_stock_sales, round(zero / n, 6) as stockout_rate
        from (select store_id, product_id, avg(v) filter (v > 0) as pos, count(*) filter (v = 0) as zero, count(*) as n
              from (select store_id, product_id, unnest(sold) as v from facts) group by 1, 2) order by pos desc nulls first, store_id, product_id limit 5"""),
    "q27": hours(f"""select case when avg_temperature < 10 then 'Cold' when avg_temperature < 20 then 'Mild'
        when avg_temperature < 30 then 'Warm' else 'Hot' end as temperature_range, {CATEGORY}, sum(v) as total
        from hours group by all order by 1"""),
    "q28": hours("""select product_id, count(*) as total_hours, count(*) filter (v = 0) as stockout,
        round(count(*) filter (v = 0) / count(*), 6) as stockout_rate from hours where h in (8, 9, 10) group by 1"""),
    "q29": hours("select lost_units_due_to_stockouts from intel", INTEL),
}
