"""SQL counterparts of the models over all features: the matrix of sums of products and its solution by conjugate gradients
or, for penalties on absolute weights, by accelerated proximal gradients, as recursive queries."""

from __future__ import annotations

import re

from .. import constants as k
from . import oracles_features as f
from .oracles import facts

# Every solution below starts from a table `sums` of problems (columns s, b, n, l1, l2 and whatever tells them apart) and ends
# in a table `found` with their weights w.

#: Numbers that models learn from, in the order of the table: what the facts hold and what is derived from them.
GIVEN = """management_group_id first_category_id second_category_id third_category_id discount holiday_flag activity_flag precpt
    avg_temperature avg_humidity avg_wind_level stock_hour6_22_cnt""".split()


def exact(sql: str) -> str:
    """Without the rounding that comparisons need."""
    return re.sub(r"round\((.*), 6\)$", r"\1", sql)


ADDED = {name: exact(sql) for group in (f.CALENDAR, f.CYCLES, f.WEEK, f.RUSH, f.HOLIDAY, f.elapsed(f.FIRST.format("base")), f.LAGS, f.STOCK_LAGS,
                                        f.MEANS, f.STDS, f.MAXES, f.MEDIANS, f.RATIO) for name, sql in group.items()}
LATER = {name: exact(sql) for name, sql in f.FOURIER.items()} | {
    "unmet_demand": f.UNMET.removesuffix(" as unmet_demand"), "temp_hour_interaction": "avg_temperature * hour",
    "rain_weekend_interaction": "precpt * is_weekend", "discount_weekend": "discount * is_weekend",
    "discount_evening": "discount * is_evening_rush", "stock_hour_interaction": "stock_status * hour"}
STATISTICS = ["store_avg_sales", "store_sales_volatility", "store_max_sales", "store_product_count", "product_avg_sales",
              "product_sales_volatility", "product_store_count"]
FEATURES = [*GIVEN, *ADDED, *LATER, *STATISTICS]


def features_of(part: str, fitted: str = "train") -> str:
    """All features of the rows of a part; statistics and the start of time come from the fitted part."""
    first = f"(select min(dt)::timestamp from {fitted})"
    added = {name: sql.replace(f.FIRST.format("base"), first) for name, sql in ADDED.items()}
    return f"""
{part}_base as (select *, list_contains(st, 1)::int as stock_status from {part}),
{part}_early as (select *, row_number() over {f.W} - 1 as t, {f.cols(added)} from {part}_base),
{part}_x as (select store_id, product_id, dt, sale_amount as y, {', '.join(f'"{c}"' for c in [*GIVEN, *ADDED])}, {f.cols(LATER)},
    {', '.join(STATISTICS)} from {part}_early left join store_stats using (store_id) left join product_stats using (product_id))"""


STATISTICS_OF_TRAIN = (f.STORE_STATS + "," + f.PRODUCT_STATS).replace("from base", "from train")


def listed(values) -> str:
    return "[" + ", ".join(values) + "]"


SIZE = len(FEATURES)
ZEROS = f"list_transform(range({SIZE}), lambda i: 0.0::double)"
PRODUCTS = f"""{listed(listed(f'avg(z{min(i, j)} * z{max(i, j)})' for j in range(SIZE)) for i in range(SIZE))} as s,
    {listed(f'avg(z{i} * y)' for i in range(SIZE))} as b"""


def scaled_train(case: str = "0", rows: str = "train_x") -> str:
    """Rows with medians for missing cells, scaled, and their sums of products, for every value of ``case``."""
    return f"""
medians as (select {case} as h, {', '.join(f'median("{c}") as "{c}"' for c in FEATURES)} from {rows} group by 1),
filled as (select m.h, y, {', '.join(f'coalesce(x."{c}", m."{c}")::double as "{c}"' for c in FEATURES)} from {rows} x join medians m on m.h = {case}),
spread as (select h, count(*) as n, avg(y) as my, {', '.join(f'avg("{c}") as "m_{c}", if(max("{c}") = min("{c}"), 1, stddev_pop("{c}")) as "s_{c}"' for c in FEATURES)} from filled group by h),
z as (select f.h, n, my, y - my as y, {', '.join(f'("{c}" - "m_{c}") / "s_{c}" as z{i}' for i, c in enumerate(FEATURES))} from filled f join spread using (h)),
products as (select h, any_value(n) as n, any_value(my) as my, {PRODUCTS} from z group by h)"""


#: Least squares by elimination in the order of the inputs; one that depends on earlier ones gets weight 0.
ELIMINATED = f"""
steps as (
  select h, n, my, name, alpha, 0 as j, list_transform(range(1, {SIZE} + 1), lambda i: list_append(list_transform(s[i], lambda x, c: x + if(c = i, l2, 0)), b[i])) as m
  from sums where l1 = 0
  union all
  select h, n, my, name, alpha, j + 1, if(m[j + 1][j + 1] < 1e-12, m, list_transform(m, lambda row, i: if(i = j + 1, row,
      list_transform(list_zip(row, m[j + 1]), lambda x: x[1] - row[j + 1] / m[j + 1][j + 1] * x[2]))))
  from steps where j < {SIZE}
),
found_plain as (select h, n, my, name, alpha, list_transform(range(1, {SIZE} + 1), lambda i: if(m[i][i] < 1e-12, 0, m[i][{SIZE} + 1] / m[i][i])) as w
  from steps where j = {SIZE})"""

#: The minimum of w's w / 2 - b'w + l1 |w| + l2 w'w / 2 by accelerated proximal gradients with restarts. Of inputs that say the
#: same, the first one carries the weight, unless l2 settles how they share it.
PROXIMAL = f"""
single as (
  select *, list_transform(range(1, {SIZE} + 1), lambda i: if(len(list_filter(range(1, i), lambda j: abs(s[i][j]) > 1 - 1e-9)) > 0 and l2 = 0, 0, 1)) as one,
    l2 + list_max(list_transform(s, lambda row: list_sum(list_transform(row, lambda x: abs(x))))) as steep
  from sums where l1 > 0
),
way as (
  select h, n, my, name, alpha, 0 as i, {ZEROS} as w, {ZEROS} as v, 1.0::double as t, 1.0::double as moved from single
  union all
  select h, n, my, name, alpha, i + 1, w2, if(back > 0, w2, list_transform(list_zip(w2, w), lambda x: x[1] + (t - 1) / t2 * (x[1] - x[2]))),
         if(back > 0, 1.0, t2), moved2
  from (select h, n, my, name, alpha, i, w, w2, t, moved, (1 + sqrt(1 + 4 * t * t)) / 2 as t2,
            list_sum(list_transform(list_zip(v, w2, w), lambda x: (x[1] - x[2]) * (x[2] - x[3]))) as back,
            list_max(list_transform(list_zip(w2, w), lambda x: abs(x[1] - x[2]))) as moved2
        from (select q.*, list_transform(range(1, {SIZE} + 1), lambda c: one[c] * sign(u[c]) * greatest(abs(u[c]) - l1 / steep, 0)) as w2
              from (select way.*, one, steep, l1,
                        list_transform(list_zip(v, s, b), lambda x: x[1] - (list_dot_product(x[2], v) + l2 * x[1] - x[3]) / steep) as u
                    from way join single using (h, name, alpha)) as q))
  where (moved > 1e-13 or i < 10) and i < 20000
),
found_sparse as (select h, n, my, name, alpha, w from way qualify row_number() over (partition by h, name, alpha order by i desc) = 1)"""

FOUND = """
found as (select * from found_plain union all select * from found_sparse)"""

#: model, alpha, l1 and l2 of each configured linear model
CONFIGURED = {"linear": (0.0, "0.0", "0.0"), "ridge": (k.MODEL_SETTINGS["ridge"]["alpha"], "0.0", f"{k.MODEL_SETTINGS['ridge']['alpha']} / n"),
              "lasso": (k.MODEL_SETTINGS["lasso"]["alpha"], repr(k.MODEL_SETTINGS["lasso"]["alpha"]), "0.0")}
_ELASTIC = k.MODEL_DEFAULTS["elasticnet"]
CONFIGURED["elasticnet"] = (_ELASTIC["alpha"], repr(_ELASTIC["alpha"] * _ELASTIC["l1_ratio"]), repr(_ELASTIC["alpha"] * (1 - _ELASTIC["l1_ratio"])))


def problems(*cases: tuple[str, float, str, str]) -> str:
    rows = " union all ".join(f"select '{name}' as name, {alpha!r}::double as alpha, {l1}::double as l1, ({l2})::double as l2, products.* from products"
                              for name, alpha, l1, l2 in cases)
    return f"\nsums as ({rows})"


def on_features(select: str, *parts: str) -> str:
    return "with recursive " + ",\n".join([facts("", f.SPLIT).strip().removeprefix("with "), STATISTICS_OF_TRAIN, features_of("train"), *parts]) + select


def solved(name: str, select: str, *parts: str) -> str:
    return on_features(select, scaled_train(), problems((name, *CONFIGURED[name])), ELIMINATED, PROXIMAL, FOUND, *parts)


NAMES = listed(f"'{c}'" for c in FEATURES)


def coefficients(name: str, places: int = 5) -> str:
    return solved(name, f"""
select unnest({NAMES}) as feature, round(unnest(w), {places}) as coefficient from found
union all select 'intercept', round(my, {places}) from found""")


def normal_equations(places: int = 5) -> str:
    """Products of every input with the label, which those with the fitted values must equal."""
    return on_features(f"""
select unnest({NAMES}) as feature, round(unnest(b), {places}) as with_label, round(unnest(b), {places}) as with_fit from products""", scaled_train())


def cells(x: str = "x", m: str = "m") -> str:
    return listed(f'(coalesce({x}."{c}", {m}."{c}") - "m_{c}") / "s_{c}"' for c in FEATURES)


def forecasts(name: str, select: str) -> str:
    return solved(name, select, features_of("eval"), f"""
forecast as (select store_id, product_id, dt, y, greatest(0, my + list_dot_product(w, {cells()})) as prediction
    from eval_x x, medians m, (select * exclude (h, n, my) from spread), found)""")


GRID = [("linear", 0.0, "0.0", "0.0"), *(("ridge", a, "0.0", f"{a} / n") for a in k.MODEL_GRIDS["ridge"]["alpha"]),
        *(("lasso", a, repr(a), "0.0") for a in k.MODEL_GRIDS["lasso"]["alpha"])]


def tuning(places: int = 4) -> str:
    """Mean absolute errors over contiguous folds: every fold is solved from the rows of the others. Inputs have mean 0, so a model
    without intercept has the same weights."""
    folds = k.CV_FOLDS
    return on_features(f"""
select name as model_name, if(name = 'linear', null, alpha) as alpha, fit_intercept, round(mae, {places}) as mae,
       row_number() over (partition by name order by mae) = 1 as is_best
from (select name, alpha, fit_intercept, avg(mae) as mae from errors group by all)""", f"""
numbered as (select *, row_number() over (order by store_id, product_id, dt) - 1 as r, count(*) over () as rows_all from train_x),
placed as (select * exclude (r, rows_all), if(r < (rows_all % {folds}) * (rows_all // {folds} + 1), r // (rows_all // {folds} + 1),
    (rows_all % {folds}) + (r - (rows_all % {folds}) * (rows_all // {folds} + 1)) // (rows_all // {folds})) as fold from numbered),
learned as (select p.*, o.h as held from placed p join (select unnest(range({folds})) as h) o on p.fold <> o.h)""",
        scaled_train("held", "learned"), problems(*GRID), ELIMINATED, PROXIMAL, FOUND, f"""
scaled_folds as (select x.fold as h, x.y, spread.my, {cells()} as c from placed x join medians m on m.h = x.fold join spread on spread.h = x.fold),
errors as (select name, alpha, fit_intercept, f.h, avg(abs(y - if(fit_intercept, x.my, 0) - list_dot_product(w, c))) as mae
    from scaled_folds x join found f on f.h = x.h, (values (true), (false)) as v(fit_intercept) group by all)""")


def lasso_run(places: int = 4) -> str:
    """Metrics of a lasso run on both sets, from its own weights."""
    def measured(side: str, mase: str = "") -> str:
        return (f"select count(*) as n, round(avg(abs(y - p)), {places}) as \"{side}_MAE\", round(sqrt(avg(power(y - p, 2))), {places}) as \"{side}_RMSE\", "
                f"round(avg(p - y), {places}) as \"{side}_Bias\"{mase} from {side}_p")
    forecast = "(select y, greatest(0, my + list_dot_product(w, {})) as p from {}_x x, medians m, (select * exclude (h, n, my) from spread), found)"
    return solved("lasso", f"""
select 'baseline_lasso' as experiment, 'lasso' as model_name, t.n as n_train_samples, e.n as n_eval_samples, {SIZE}::bigint as n_features,
       t.* exclude (n), e.* exclude (n), round(list_sum(list_transform(w, lambda x: abs(x))), {places}) as importance_total
from ({measured('train')}) t, ({measured('eval', f', round(avg(abs(y - p)) / ((select avg(d) from steps_in_train) + 1e-8), {places}) as "eval_MASE"')}) e, found""",
                  features_of("eval"), f"\ntrain_p as {forecast.format(cells(), 'train')}", f"\neval_p as {forecast.format(cells(), 'eval')}",
                  "\nsteps_in_train as (select abs(sale_amount - lag(sale_amount, 1) over (partition by store_id, product_id order by dt)) as d from train)")


MODEL_ORACLES: dict[str, str] = {
    "ml_linear": normal_equations(),
    **{f"ml_{name}": coefficients(name) for name in ("ridge", "lasso", "elasticnet")},
    "ml_linear_full": forecasts("linear", """
select store_id, count(*) as n_rows, round(avg(prediction), 3) as mean_forecast from forecast group by 1"""),
    **{f"ml_{name}_full": forecasts(name, "\nselect store_id, product_id, dt, round(prediction, 5) as prediction from forecast")
       for name in ("ridge", "lasso", "elasticnet")},
    "ml_grid": tuning(),
    "ml_train_eval": lasso_run(),
}
