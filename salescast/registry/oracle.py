"""The same results in plain SQL over the raw tables, written from the contracts of the operators.

This is the checking side only: nothing here is used to compute a query.
"""

from __future__ import annotations

import re

# Fixed values of the contracts, stated here again so that an error in the code's own lists shows.
METRICS = "rmspe rmse mae mape r2 bias".split()
LINEAR_FEATURES = "promo day_of_week promo2".split()
CATEGORICAL = "state_holiday store_type assortment".split()
FEATURES = """store day_of_week promo school_holiday state_holiday store_type assortment year month day week_of_year day_of_year
 is_weekend is_month_start is_month_end competition_distance promo2 competition_months_open has_competition
 promo2_weeks_active is_promo2_month""".split()
CATEGORIES = {
    "promo": "Promotions", "promo2": "Promotions", "promo2_weeks_active": "Promotions", "store": "Store", "store_type": "Store",
    "assortment": "Store", "competition_distance": "Competition", "competition_months_open": "Competition",
}
TREES = ["RandomForest", "BoostedDeep", "BoostedLeaf"]

# Common table expressions in order of dependence.
TABLES: dict[str, str] = {
    "store": """
select cast(s_suppkey as int) as store,
  chr(cast(97 + s_suppkey % 4 as int)) as store_type,
  chr(cast(97 + s_nationkey % 3 as int)) as assortment,
  case when s_suppkey % 10 = 3 then null else cast(abs(s_acctbal) as double) end as competition_distance,
  case when s_suppkey % 3 = 0 then null else cast(1 + s_suppkey % 12 as double) end as competition_open_since_month,
  case when s_suppkey % 3 = 0 then null else cast(1994 + s_suppkey % 5 as double) end as competition_open_since_year,
  cast(s_suppkey % 2 as int) as promo2,
  case when s_suppkey % 2 = 0 then null else cast(1 + s_suppkey % 52 as double) end as promo2_since_week,
  case when s_suppkey % 2 = 0 then null else cast(1995 + s_suppkey % 4 as double) end as promo2_since_year,
  case when s_suppkey % 2 = 0 then null when s_suppkey % 6 = 1 then 'Jan,Apr,Jul,Oct'
       when s_suppkey % 6 = 3 then 'Feb,May,Aug,Nov' else 'Mar,Jun,Sept,Dec' end as promo_interval
from supplier""",
    "daily": """
select cast(l_suppkey as int) as store, cast(l_shipdate as date) as sale_date,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as gross,
  cast(count(distinct l_orderkey) as int) as customers,
  max(case when l_discount > 0.05 then 1 else 0 end) as promo
from lineitem group by 1, 2""",
    "sales_raw": """
select store, cast(dow as tinyint) as day_of_week, sale_date,
  case when dow = 7 or (store % 7 = 0 and day(sale_date) = 13) then 0
       else cast(3000 + case store % 4 when 1 then 4000 when 2 then 500 when 3 then 2500 else 0 end
                 + 1500 * promo * (case when dow in (1, 6) then 2 else 1 end) + 250 * (7 - dow)
                 + floor(gross / 100) as int) end as sales,
  case when dow = 7 then 0 else customers end as customers,
  cast(case when dow = 7 then 0 else 1 end as tinyint) as open,
  cast(promo as tinyint) as promo,
  case when month(sale_date) = 12 and day(sale_date) in (25, 26) then 'c'
       when month(sale_date) = 1 and day(sale_date) = 1 then 'a'
       when month(sale_date) = 4 and day(sale_date) = 15 then 'b' else '0' end as state_holiday,
  cast(case when month(sale_date) in (7, 8) then 1 else 0 end as tinyint) as school_holiday
from (select *, cast(isodow(sale_date) as int) as dow from daily) d""",
    "sales_train": """
select * from sales_raw
where sale_date <= (select cast(max(sale_date) - interval 42 days as date) from sales_raw)""",
    "sales_horizon": """
select cast(store as bigint) * 100000000 + year(sale_date) * 10000 + month(sale_date) * 100 + day(sale_date) as id,
  store, day_of_week, sale_date,
  cast(case when store % 11 = 0 then null else open end as double) as open, promo,
  case when day(sale_date) = 31 then 'z' else state_holiday end as state_holiday, school_holiday
from sales_raw
where sale_date > (select cast(max(sale_date) - interval 42 days as date) from sales_raw)""",
    "enriched": "select * from sales_train left join store using (store)",
    "enriched_horizon": "select * from sales_horizon left join store using (store)",
    "clean": "select * from sales_train where open = 1 and sales > 0",
    "clean_enriched": "select * from clean left join store using (store)",
    "train_median": "select median(competition_distance) as m from clean_enriched",
    "horizon_median": "select median(competition_distance) as m from enriched_horizon",
    "labels": " union all ".join(
        f"""
select '{c}' as "column", label, cast(row_number() over (order by label) - 1 as int) as code
from (select distinct coalesce({c}, 'nan') as label from clean_enriched) t"""
        for c in CATEGORICAL
    ),
}


def _preprocessed(source: str, median: str, extra: str) -> str:
    """Features of ``source``: imputed, dated, with competition and promotion features, encoded."""
    codes = ",\n  ".join(
        f"coalesce((select code from labels l where l.\"column\" = '{c}' and l.label = coalesce(t.{c}, 'nan')), -1)"
        f" as {c}"
        for c in CATEGORICAL
    )
    names = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
    return f"""
select {extra}, t.store, t.day_of_week, t.sale_date, t.open, t.promo, t.school_holiday,
  {codes},
  coalesce(competition_distance, (select m from {median})) as competition_distance,
  coalesce(competition_open_since_month, 0) as competition_open_since_month,
  coalesce(competition_open_since_year, 0) as competition_open_since_year,
  promo2, coalesce(promo2_since_week, 0) as promo2_since_week, coalesce(promo2_since_year, 0) as promo2_since_year,
  coalesce(promo_interval, '') as promo_interval,
  cast(year(sale_date) as int) as year, cast(month(sale_date) as int) as month, cast(day(sale_date) as int) as day,
  cast(week(sale_date) as int) as week_of_year, cast(dayofyear(sale_date) as int) as day_of_year,
  case when day_of_week >= 6 then 1 else 0 end as is_weekend,
  case when day(sale_date) = 1 then 1 else 0 end as is_month_start,
  case when month(sale_date + interval 1 day) <> month(sale_date) then 1 else 0 end as is_month_end,
  cast(case when competition_open_since_year > 0 and competition_open_since_month > 0 then greatest(0,
    (year(sale_date) - competition_open_since_year) * 12 + month(sale_date) - competition_open_since_month)
    else 0 end as int) as competition_months_open,
  case when coalesce(competition_distance, (select m from {median})) > 0 then 1 else 0 end as has_competition,
  cast(case when promo2_since_year > 0 and promo2_since_week > 0 then greatest(0,
    (year(sale_date) - promo2_since_year) * 52 + week(sale_date) - promo2_since_week)
    else 0 end as int) as promo2_weeks_active,
  case when strpos(coalesce(promo_interval, ''), {names}[month(sale_date)]) > 0 then 1 else 0 end as is_promo2_month
from {source} t"""


def _covariance(a: str, b: str) -> str:
    return f"covar_pop(cast({a} as double), cast({b} as double))"


def _line() -> str:
    """Least squares with three inputs: Cramer's rule on the centred normal equations."""
    a, b, c = LINEAR_FEATURES
    y = "sales"
    pairs = {"aa": (a, a), "ab": (a, b), "ac": (a, c), "bb": (b, b), "bc": (b, c), "cc": (c, c)}
    pairs |= {"ay": (a, y), "by_": (b, y), "cy": (c, y)}
    moments = ", ".join(f"{_covariance(*p)} as {name}" for name, p in pairs.items())
    means = ", ".join(f"avg(cast({v} as double)) as m{i}" for i, v in enumerate([a, b, c, y]))
    return f"""
select w0, w1, w2, m3 - w0 * m0 - w1 * m1 - w2 * m2 as intercept from (
  select *,
    (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det as w0,
    (aa * (by_ * cc - cy * bc) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det as w1,
    (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det as w2
  from (select *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) as det
        from (select {moments}, {means} from features_split where split = 'train') s) d) w"""


def _predicted_line(alias: str) -> str:
    a, b, c = LINEAR_FEATURES
    return f"greatest(intercept + w0 * {alias}.{a} + w1 * {alias}.{b} + w2 * {alias}.{c}, 0)"


TABLES |= {
    "features": _preprocessed("clean_enriched", "train_median", "t.sales, t.customers"),
    "features_horizon": _preprocessed(
        "(select * exclude (open), coalesce(open, 1.0) as open from enriched_horizon)", "horizon_median", "t.id"
    ),
    "features_split": """
select *, case when sale_date < (select cast(max(sale_date) - interval 42 days as date) from features)
  then 'train' else 'validation' end as split from features""",
    "clean_split": """
select *, case when sale_date < (select cast(max(sale_date) - interval 42 days as date) from clean)
  then 'train' else 'validation' end as split from clean""",
    "means": """
select store, day_of_week, promo, avg(sales) as group_mean from clean_split where split = 'train' group by all""",
    "overall": "select avg(sales) as mean from clean_split where split = 'train'",
    "baseline": """
select c.*, coalesce(group_mean, mean) as by_group, mean as by_mean
from clean_split c left join means using (store, day_of_week, promo) cross join overall""",
    "line": _line(),
    "predictions": """
select 'mean_baseline' as model, split, cast(sales as double) as y, by_group as yhat from baseline
union all select 'global_mean', split, sales, by_mean from baseline""",
    "predictions3": f"""
select * from predictions
union all select 'LinearRegression', split, f.sales, {_predicted_line('f')} from features_split f cross join line""",
}


def _metrics(source: str) -> str:
    return f"""
select model, split,
  coalesce(sqrt(avg(power((y - yhat) / y, 2)) filter (y > 0)), 0) as rmspe,
  sqrt(avg(power(y - yhat, 2)) filter (y > 0)) as rmse,
  avg(abs(y - yhat)) filter (y > 0) as mae,
  100 * avg(abs((y - yhat) / y)) filter (y > 0) as mape,
  1 - sum(power(y - yhat, 2)) filter (y > 0) / sum(power(y - mean_y, 2)) filter (y > 0) as r2,
  avg(yhat - y) filter (y > 0) as bias
from (select *, avg(y) filter (y > 0) over (partition by model, split) as mean_y from {source}) t
group by model, split"""


def _moments() -> str:
    """The correlation matrix of all features, with the target as last column; constant features have zeros."""

    def correlation(a: str, b: str) -> str:
        return f"coalesce({_covariance(a, b)} / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 0)"

    rows = [f"[{', '.join(correlation(a, b) for b in [*FEATURES, 'sales'])}]" for a in FEATURES]
    spreads = ", ".join(f"stddev_pop({f})" for f in FEATURES)
    means = ", ".join(f"avg({f})" for f in FEATURES)
    return f"""
select [{', '.join(rows)}] as m, [{spreads}] as sd, [{means}] as mu, stddev_pop(sales) as sd_y, avg(sales) as mu_y
from features_split where split = 'train'"""


# Gauss-Jordan elimination, one recursion step per feature; a zero pivot leaves its feature out.
ELIMINATION = f"""
with recursive steps as (
  select 1 as k, m from moments
  union all
  select k + 1, list_transform(m, lambda r, i: case when abs(m[k][k]) < 1e-9 then r
      when i = k then list_transform(r, lambda v: v / m[k][k])
      else list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) end)
  from steps where k <= {len(FEATURES)})
select list_transform(s.m, lambda r, i: case when t.m[i][i] < 1e-9 then 0
    else r[{len(FEATURES) + 1}] * t.sd_y / t.sd[i] end) as w, t.mu, t.mu_y
from steps s cross join moments t where s.k = {len(FEATURES) + 1}"""


def _predicted_full(alias: str) -> str:
    terms = " + ".join(f"w[{i}] * ({alias}.{f} - mu[{i}])" for i, f in enumerate(FEATURES, 1))
    return f"greatest(mu_y + {terms}, 0)"


TABLES |= {
    "moments": _moments(),
    "full_line": ELIMINATION,
    "predictions_full": f"""
select 'LinearRegression' as model, split, cast(f.sales as double) as y, {_predicted_full('f')} as yhat
from features_split f cross join full_line""",
    "scores_full": _metrics("predictions_full"),
    "coefficients": " union all ".join(
        f"\nselect '{f}' as feature, abs(w[{i}]) as importance from full_line" for i, f in enumerate(FEATURES, 1)
    ),
    "top10_full": "select * from coefficients order by importance desc, feature limit 10",
    "scores": _metrics("predictions"),
    "scores3": _metrics("predictions3"),
    "importances": " union all ".join(
        f"\nselect '{f}' as feature, case when min({f}) = max({f}) then 0"
        f" else abs(regr_slope(cast(sales as double), cast({f} as double))) end as importance from features"
        for f in FEATURES
    ),
    "top10": "select * from importances order by importance desc, feature limit 10",
    "scores2": "select * from scores3 where model <> 'mean_baseline'",
    "line_importances": " union all ".join(
        f"\nselect '{f}' as feature, abs(w{i}) as importance from line where 'LinearRegression' = (select model from scores2"
        " where split = 'validation' order by rmspe, model limit 1)" for i, f in enumerate(LINEAR_FEATURES)
    ),
    "baseline_horizon": """
select h.*, case when coalesce(open, 1) = 0 then 0 else coalesce(group_mean, mean) end as yhat
from sales_horizon h left join means using (store, day_of_week, promo) cross join overall""",
}


def _with(select: str) -> str:
    """Prepend the tables that ``select`` needs, directly or not."""
    needed: list[str] = []
    text = select
    for name, body in reversed(TABLES.items()):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, f"{name} as ({body})")
            text += body
    return f"with {', '.join(needed)}\n{select}" if needed else select


def _round(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns.split())


def _histogram(source: str, value: str, extra: str = "") -> str:
    """Bins by comparing each value with the edges of all 50 bins."""
    return f"""
select {extra} cast(b as int) as bin, round(lo + b * width, 6) as low,
  round(case when b = 49 then hi else lo + (b + 1) * width end, 6) as high,
  (select count(*) from {source} v where v.{value} >= lo + b * width
     and (v.{value} < lo + (b + 1) * width or b = 49)) as count
from range(50) bins(b), (select cast(min({value}) as double) as lo, cast(max({value}) as double) as hi,
  (cast(max({value}) as double) - cast(min({value}) as double)) / 50 as width from {source}) r"""


def _nulls(table: str, columns: list[str], dataset: str | None = None) -> str:
    tag = f", '{dataset}' as dataset" if dataset else ""
    return " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as missing{tag} from {table}" for c in columns
    )


SALES_COLUMNS = "store day_of_week sale_date sales customers open promo state_holiday school_holiday".split()
STORE_COLUMNS = (
    "store_type assortment competition_distance competition_open_since_month competition_open_since_year "
    "promo2 promo2_since_week promo2_since_year promo_interval"
).split()

COLUMNS_BY_TYPE = {
    "int": ["store", "sales", "customers", "promo2"],
    "tinyint": ["day_of_week", "open", "promo", "school_holiday"],
    "date": ["sale_date"],
    "string": ["state_holiday", "store_type", "assortment", "promo_interval"],
    "double": [c for c in STORE_COLUMNS if c.startswith("competition") or c.startswith("promo2_")],
}


def _report(scores: str, top: str, extra: str = "") -> str:
    pairs = [(m, side) for m in ("rmspe", "rmse", "mape", "r2") for side in ("train", "validation")]
    comparison = " union all ".join(
        f"select 'comparison' as section, rank, s.model as item,"
        f" '{'train' if side == 'train' else 'val'}_{m}' as metric, {m} as value"
        f" from {scores} s join ranks using (model) where split = '{side}'"
        for m, side in pairs
    )
    best = " union all ".join(
        f"select 'best_model', {i + 1}, model, '{m}', {m} from {scores} join ranks using (model)"
        f" where rank = 1 and split = 'validation'"
        for i, m in enumerate(METRICS)
    )
    return f"""
select section, cast(rank as int) as rank, item, metric, round(value, {{digits}}) as value from (
  with ranks as (select model, row_number() over (order by rmspe, model) as rank from {scores}
                 where split = 'validation')
  {comparison} union all {best} union all
  select 'importance', row_number() over (order by importance desc, feature), feature, 'share_pct',
    100 * importance / (select sum(importance) from {top}) from {top} {extra}) r"""


def _categories() -> str:
    cases = " ".join(f"when '{f}' then '{c}'" for f, c in CATEGORIES.items())
    return f"""
select category, {_round('importance')}, round(100 * importance / (select sum(importance) from importances), 6)
  as share_pct
from (select case feature {cases} else 'Time' end as category, sum(importance) as importance
      from importances group by 1) c"""


def _fits(models: list[str], facts: str) -> str:
    names = ", ".join(f"('{m}')" for m in models)
    return f"""
select model, split, count(*) as rows, {facts} from features_split, (values {names}) v(model) group by model, split"""


def _line_run() -> str:
    """What the run with the line and the forest reports of itself."""
    pairs = [(m, side) for m in ("rmspe", "rmse", "mape", "r2") for side in ("train", "validation")]
    comparison = " union all ".join(
        f"select 'comparison' as section, 'LinearRegression' as item,"
        f" '{'train' if side == 'train' else 'val'}_{m}' as metric, {m} as value from scores_full where split = '{side}'"
        for m, side in pairs
    )
    counts = {
        "input_rows": "select count(*) from sales_train", "closed_removed": "select count(*) from sales_train where open <> 1",
        "rows_after": "select count(*) from clean",
    }
    audits = [("cleaning", k, v) for k, v in counts.items()]
    audits += [("split", f"{side}_rows", f"select count(*) from clean_split where split = '{side}'") for side in ("train", "validation")]
    audits += [("horizon", "rows", "select count(*) from sales_horizon"), ("forecast", "rows", "select count(*) from sales_horizon"),
               ("forecast", "closed", "select count(*) from sales_horizon where open = 0"),
               ("forecast", "closed_with_sales", "select 0"), ("forecast", "negative", "select 0")]
    rest = " union all ".join(f"select '{a}', '', '{m}', cast(({q}) as double)" for a, m, q in audits)
    return f"select section, item, metric, round(value, 3) as value from ({comparison} union all {rest}) r"


FEATURE_KEYS = {
    "feat_year": "year", "feat_month": "month", "feat_day": "day", "feat_week": "week_of_year",
    "feat_doy": "day_of_year", "feat_weekend": "is_weekend", "feat_month_start": "is_month_start",
    "feat_month_end": "is_month_end",
}
CALENDAR = {
    "year": "cast(year(sale_date) as int)",
    "month": "cast(month(sale_date) as int)",
    "day": "cast(day(sale_date) as int)",
    "week_of_year": "cast(strftime(sale_date, '%V') as int)",
    "day_of_year": "cast(strftime(sale_date, '%j') as int)",
    "is_weekend": "cast(day_of_week in (6, 7) as int)",
    "is_month_start": "cast(sale_date = date_trunc('month', sale_date) as int)",
    "is_month_end": "cast(sale_date = last_day(sale_date) as int)",
}


def _missing_cells(table: str, columns: list[str]) -> str:
    return " + ".join(f"count(*) - count({c})" for c in columns)


SELECTS: dict[str, str] = {
    "scan_sales": "select * from sales_train",
    "scan_horizon": "select * from sales_horizon",
    "scan_store": "select * from store",
    "required_nulls": _nulls(
        "sales_train", "store day_of_week sales customers open promo school_holiday".split(), "sales"
    )
    + " union all "
    + _nulls("sales_horizon", "id store day_of_week promo school_holiday open".split(), "horizon"),
    "forecast_sink": "select id, round(yhat, 6) as sales from baseline_horizon",
    "enrich_store": """select store, sale_date, sales, store_type, assortment, competition_distance, promo_interval
from enriched""",
    "enriched_sales": "select * from enriched",
    "enriched_horizon": "select * from enriched_horizon",
    "dataset_summary": f"""
select 'sales' as name, rows, cast({len(SALES_COLUMNS) + len(STORE_COLUMNS)} as int) as columns, missing_cells,
  round(100.0 * missing_cells / (rows * {len(SALES_COLUMNS) + len(STORE_COLUMNS)}), 6) as missing_pct
from (select count(*) as rows, {_missing_cells('enriched', SALES_COLUMNS + STORE_COLUMNS)} as missing_cells
      from enriched) t""",
    "column_types": " union all ".join(
        f"select '{kind}' as type, {len(columns)} as columns, {_missing_cells('enriched', columns)} as missing"
        " from enriched"
        for kind, columns in COLUMNS_BY_TYPE.items()
    ),
    # Imputation covers every store attribute with gaps, so only the horizon's open column is left.
    "remaining_nulls": "select * from (" + _nulls("enriched_horizon", ["open"]) + ") t where missing > 0",
    "cleaning_audit": """
select count(*) as input_rows, count(*) filter (open is distinct from 1) as closed_removed,
  (select count(*) from clean) as rows_after from sales_train""",
    "split_audit": """
select split, count(*) as rows, min(sale_date) as first_date, max(sale_date) as last_date,
  (select cast(max(sale_date) - interval 42 days as date) from clean) as split_date
from clean_split group by split""",
    "filter_open": "select * from sales_train where open = 1",
    "filter_positive_sales": "select * from clean",
    "fill_open": "select * exclude (open), coalesce(open, 1.0) as open from sales_horizon",
    "impute_distance": "select store, sale_date, competition_distance from features",
    "impute_since": """
select store, sale_date, competition_open_since_month, competition_open_since_year, promo2_since_week,
  promo2_since_year from features""",
    "impute_interval": "select store, sale_date, promo_interval from features",
    "date_normalize": "select l_orderkey, l_linenumber, cast(l_shipdate as date) as l_shipdate from lineitem",
    "date_features": "select store, sale_date, "
    + ", ".join(f"{e} as {c}" for c, e in CALENDAR.items())
    + " from clean",
    **{
        key: f"select store, sale_date, {CALENDAR[column]} as {column} from sales_train"
        for key, column in FEATURE_KEYS.items()
    },
    "comp_months_open": "select store, sale_date, competition_months_open from features",
    "has_competition": """
select store, sale_date, case when competition_distance > 0 then 1 else 0 end as has_competition
from clean_enriched""",
    "promo2_weeks": "select store, sale_date, promo2_weeks_active from features",
    "promo2_month": "select store, sale_date, is_promo2_month from features",
    "label_fit": "select * from labels",
    "label_fit_transform": "select store, sale_date, state_holiday, store_type, assortment from features",
    "label_transform": "select id, state_holiday, store_type, assortment from features_horizon",
    "feature_matrix": f"select {', '.join(FEATURES)}, sales from features",
    "split_weeks": "select store, sale_date, sales, split from clean_split",
    "split_ratio": """
select store, sale_date, sales, case when sale_date < (
    select min(sale_date) + cast(floor((max(sale_date) - min(sale_date)) * 0.8) as int) from clean)
  then 'train' else 'validation' end as split from clean""",
    "sort_by_date": "select store, sale_date, sales from clean order by sale_date",
    "preprocess_train": "select * from features",
    "preprocess_horizon": "select * from features_horizon",
    "linear_model": "select 'intercept' as term, round(intercept, 4) as value from line"
    + "".join(f" union all select '{f}', round(w{i}, 4) from line" for i, f in enumerate(LINEAR_FEATURES)),
    "predict": f"""
select store, sale_date, split, round({_predicted_line('f')}, 3) as yhat from features_split f cross join line""",
    "importance_linear": " union all ".join(
        f"select '{f}' as feature, round(abs(w{i}), 4) as importance from line" for i, f in enumerate(LINEAR_FEATURES)
    ),
    "importance_table": " union all ".join(
        f"select 'feature_{i}' as feature, round(abs(w{i}), 4) as importance from line" for i in range(3)
    ),
    "mean_baseline": "select store, sale_date, split, round(by_group, 6) as yhat from baseline",
    **{f"metric_{m}": f"select model, split, {_round(m)} from scores" for m in METRICS},
    "metrics_all": f"select model, split, {_round(' '.join(METRICS))} from scores",
    "evaluate_model": f"select split, {_round(' '.join(METRICS))} from scores where model = 'mean_baseline'",
    "comparison_table": "select model, "
    + ", ".join(
        f"round(max({m}) filter (split = '{split}'), 5) as {side}_{m}"
        for m in ("rmspe", "rmse", "mape", "r2")
        for side, split in (("train", "train"), ("val", "validation"))
    )
    + ", cast(null as double) as train_unknown, cast(null as double) as val_unknown from scores3 group by model",
    "best_model": """
select model as best_model from scores3 where split = 'validation' order by rmspe, model limit 1""",
    "importance_top_n": f"""
select feature, {_round('importance')} from importances order by importances.importance desc, feature limit 20""",
    "importance_share": f"""
select feature, {_round('importance')},
  round(100 * importance / (select sum(importance) from top10), 6) as share_pct,
  round(100 * importance / (select sum(importance) from importances), 6) as share_of_all_pct
from top10""",
    "evaluation_report": _report("scores2", "line_importances").format(digits=4),
    "one_split": """
select cast(promo as int) as promo, round(avg(sales), 4) as yhat from features_split where split = 'train' group by promo""",
    "forest_model": _fits(["RandomForest"], "true as in_range, true as beats_mean"),
    "boosted_deep": _fits(["BoostedDeep"], "true as in_range, true as beats_mean"),
    "boosted_leaf": _fits(["BoostedLeaf"], "true as in_range, true as beats_mean"),
    "train_all": _fits(TREES, "true as beats_mean") + """
union all select 'LinearRegression', split, count(*),
  sqrt(avg(pow((y - yhat) / y, 2))) < (select sqrt(avg(pow((q.y - m.mean) / q.y, 2))) from predictions_full q cross join
    (select avg(sales) as mean from features_split where split = 'train') m where q.split = p.split and q.y > 0)
from predictions_full p where y > 0 group by split""",
    "importance_tree": f"""
select 'RandomForest' as model, cast({len(FEATURES)} as bigint) as features, cast(1 as double) as total, true as none_negative,
  true as promo_counts""",
    "training_time": """
select model, count(*) as rows, true as measured from features_split, (values ('LinearRegression'), ('RandomForest')) v(model)
where split = 'train' group by model""",
    "pred_sample": """
select least(5000, count(*)) as rows, cast(0 as bigint) as strange, true as bounds_fit from baseline where split = 'train'""",
    "forecast_pipeline": _line_run(),
    "linear_model_all_features": f"select model, split, {_round(' '.join(METRICS), 4)} from scores_full",
    "pipeline_linear": _report(
        "scores_full",
        "top10_full",
        f"""union all select 'forecast', 1, 'LinearRegression', metric, value from (
  unpivot (select cast(count(*) as double) as rows, round(sum(case when open = 0 then 0
           else {_predicted_full('h')} end), 1) as sales from features_horizon h cross join full_line) on rows, sales into name metric value value) u""",
    ).format(digits=3),
    "score_horizon": f"""
select id, open, round(case when open = 0 then 0 else {_predicted_line('h')} end, 3) as yhat
from features_horizon h cross join line""",
    "saved_forecaster": f"""
select id, open, round(case when open = 0 then 0 else {_predicted_line('h')} end, 3) as yhat
from features_horizon h cross join line""",
    "duplicate_keys": """
select store, copies, fact_rows, fact_rows * (copies - 1) as extra_rows
from (select store, 1 + cast(store % 13 = 0 as bigint) + cast(store % 26 = 0 as bigint) as copies from store) s
join (select store, count(*) as fact_rows from sales_train group by store) f using (store) where copies > 1""",
    "tune_time_folds": """
select 'LinearRegression' as model, parameters, fold,
  round(sqrt(avg(((sales - greatest(0, base + slope * promo)) / sales) * ((sales - greatest(0, base + slope * promo)) / sales))), 6) as rmspe
from (select fold, cut, until, unnest(['{}', '{"fitIntercept": false}']) as parameters,
    unnest([covar_pop(y, x) / var_pop(x), sum(x * y) / sum(x * x)]) as slope,
    unnest([avg(y) - covar_pop(y, x) / var_pop(x) * avg(x), 0.0]) as base
  from (select fold, cast(last - (4 - fold) * 42 as date) as cut, cast(case when fold < 3 then last - (3 - fold) * 42 else last + 1 end as date) as until
    from (select max(sale_date) as last from clean) d, (select cast(unnest([1, 2, 3]) as integer) as fold) n) f
  join (select sale_date, cast(sales as double) as y, cast(promo as double) as x from clean) t on t.sale_date < f.cut
  group by fold, cut, until) m
join clean c on c.sale_date >= m.cut and c.sale_date < m.until
group by parameters, fold""",
    "zero_closed": f"select id, coalesce(open, 1.0) as open, {_round('yhat')} from baseline_horizon",
    "forecast_table": "select id, round(yhat, 6) as sales from baseline_horizon",
    "comparison_long": """
select model, split, case when model = 'global_mean' and split = 'train' then null else round(rmspe, 6) end as score
from scores""",
    "residuals": f"""
select store, sale_date, round(by_group, 6) as yhat, round(sales - by_group, 6) as residual
from baseline where split = 'validation'""",
    "residual_hist": _histogram(
        "(select sales - by_group as residual from baseline where split = 'validation')", "residual"
    ),
    "sales_hist": " union all ".join(
        _histogram(f"(select sales from clean_split where split = '{s}')", "sales", f"'{s}' as split,")
        for s in ("train", "validation")
    ),
    "model_ranking": """
select model, round(100 * rmspe, 4) as val_rmspe_pct from scores3 where split = 'validation' order by rmspe""",
    "importance_by_category": _categories(),
    "model_scores_normalized": """
select model, round(1 - rmspe / max(rmspe) over (), 6) as rmspe_score, round(r2, 6) as r2_score,
  round(1 - cost / max(cost) over (), 6) as speed_score
from scores join (values ('mean_baseline', 4.0::double), ('global_mean', 1.0::double)) c(model, cost) using (model)
where split = 'validation'""",
}

ORACLE: dict[str, str] = {name: _with(select) for name, select in SELECTS.items()}
