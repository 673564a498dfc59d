"""Forecasts, trend tests and regression on the fact panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import panels as P
from catalog.registry import query, rounded
from catalog.sql import cte, r, sql
from panelkit.functions.numeric import round_half_up, t_quantile
from panelkit.operators import forecast as O
from panelkit.operators.regression import ols_coefficients
from panelkit.session import materialise

H = 3

# Revenue in millions keeps the digits that are compared well above rounding noise.
cte("p1m", "select entity, period, cast(cents as double) / 100000000 as value, n_rows, population from p1")
cte("line", """
select entity, count(*) as n, max(period) as last_t, avg(period) as mt, avg(value) as mv, regr_slope(value, period) as b,
       regr_sxx(value, period) as sxx,
       greatest(regr_syy(value, period) - regr_slope(value, period) * regr_sxy(value, period), 0) as sse
from p1m group by entity
""")
STEPS = "(select unnest([1, 2, 3]) as k)"


def tail_sql(theta: str, dof: str) -> str:
    """Two-sided Student t tail at the angle atan(|t| / sqrt(dof)), as the finite sum for whole dof."""
    return f"""1 - case when {dof} % 2 = 1
            then 2 / pi() * ({theta} + case when {dof} > 1 then sin({theta}) * list_sum(list_transform(range(0, ({dof} - 1) // 2), lambda j:
                   sqrt(pi()) / 2 * exp(lgamma(j + 1) - lgamma(j + 1.5)) * cos({theta}) ** (2 * j + 1))) else 0 end)
            else sin({theta}) * list_sum(list_transform(range(0, {dof} // 2), lambda j:
                   exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * cos({theta}) ** (2 * j))) end"""


def millions(spark, sf):
    return P.p1(spark, sf).withColumn("value", F.col("cents").cast("double") / 100000000)


def band_sql(yhat: str, spread: str, digits: int = 6) -> str:
    return (f"{r(yhat, digits)} as yhat, {r(f'{yhat} - 1.28 * {spread}', digits)} as lo80, {r(f'{yhat} + 1.28 * {spread}', digits)} as hi80, "
            f"{r(f'{yhat} - 1.96 * {spread}', digits)} as lo95, {r(f'{yhat} + 1.96 * {spread}', digits)} as hi95")


@query("forecast_linear", sql(f"""
select entity, k::integer as step, (last_t + k)::integer as period, {band_sql('(mv + b * (last_t + k - mt))', '(sqrt(sse / (n - 2)) * sqrt(1 + k / n))')},
       'Linear extrapolation' as model, true as success
from line, {STEPS}
"""))
def forecast_linear(spark, sf):
    return rounded(O.forecast_linear(millions(spark, sf), P.P1, H), 6)


cte("ar", """
select entity, max(period) as last_t, arg_max(value, period) as last_v, arg_max(d, period) as last_d,
       sum(d * d1) / sum(d1 * d1) as phi, count(d1) as m, sum(d * d1) as dc,
       sum(d1 * d1) as dp, sum(case when d1 is not null then d * d end) as dn
from (select *, lag(d) over (partition by entity order by period) as d1
      from (select *, value - lag(value) over (partition by entity order by period) as d from p1m))
group by entity
""")


@query("forecast_arima", sql(f"""
select entity, k::integer as step, (last_t + k)::integer as period,
       {band_sql('(last_v + last_d * phi * (case k when 1 then 1 when 2 then 1 + phi else 1 + phi + phi * phi end))',
                 'sqrt((dn - 2 * phi * dc + phi * phi * dp) / m * (1 + case when k >= 2 then (1 + phi) * (1 + phi) else 0 end + case when k >= 3 then (1 + phi + phi * phi) * (1 + phi + phi * phi) else 0 end))')},
       'ARIMA(1,1,0)' as model, true as success
from ar, {STEPS}
"""))
def forecast_arima(spark, sf):
    return rounded(O.forecast_arima110(millions(spark, sf), P.P1, H, method="least_squares"), 6)


# The root of the slope of the likelihood, a halving of (-1, 1) at a time: it is positive left of the root.
cte("ar_likely", f"""
select *, list_reduce(list_concat([-1.0::double], [0.5::double ** k for k in range(55)]), lambda x, s:
         x + case when m * (c - (x + s) * b) * (1 - (x + s) ** 2) - (x + s) * (a - 2 * (x + s) * c + (x + s) ** 2 * b) > 0 then s else 0 end) as phi
from (select entity, max(period) as last_t, arg_max(value, period) as last_v, arg_max(d, period) as last_d, count(d) as m,
             sum(d * d) as a, sum(d * d1) as c, coalesce(sum(d * d) filter (d1 is not null and d2 is not null), 0) as b
      from (select *, lag(d) over (partition by entity order by period) as d1, lead(d) over (partition by entity order by period) as d2
            from (select *, value - lag(value) over (partition by entity order by period) as d from p1m))
      group by entity)
""")


@query("forecast_arima_likelihood", sql(f"""
select entity, k::integer as step, (last_t + k)::integer as period,
       {band_sql('(last_v + last_d * phi * (case k when 1 then 1 when 2 then 1 + phi else 1 + phi + phi * phi end))',
                 'sqrt((a - 2 * phi * c + phi * phi * b) / m * (1 + case when k >= 2 then (1 + phi) * (1 + phi) else 0 end + case when k >= 3 then (1 + phi + phi * phi) * (1 + phi + phi * phi) else 0 end))')},
       'ARIMA(1,1,0)' as model, true as success
from ar_likely, {STEPS}
"""))
def forecast_arima_likelihood(spark, sf):
    return rounded(O.forecast_arima110(millions(spark, sf), P.P1, H), 6)


# 97.5 percent points of Student's t for 1 to 8 degrees of freedom.
T975 = (12.706204736432095, 4.302652729696142, 3.182446305284263, 2.776445105197793,
        2.570581835636314, 2.446911851144969, 2.364624251592784, 2.306004135204166)


@query("trend_test", sql(f"""
select entity, n, {r('b', 6)} as slope, {r('se', 6)} as slope_se, {r('t', 6)} as t_stat,
       {r(tail_sql('th', '(n - 2)'), 6)} as p_value,
       case when b > 0 then 'increasing' else 'decreasing' end as direction,
       k::integer as step, (last_t + k)::integer as period, {r('yhat', 6)} as yhat,
       {r('yhat - half', 6)} as lo95, {r('yhat + half', 6)} as hi95
from (select *, se * 0 + [{', '.join(map(str, T975))}][n - 2] * sqrt(sse / (n - 2)) * sqrt(1 + 1 / n + (last_t + k - mt) ** 2 / sxx) as half,
             mv + b * (last_t + k - mt) as yhat
      from (select *, b / se as t, atan(abs(b / se) / sqrt(n - 2)) as th
            from (select *, sqrt(sse / (n - 2) / sxx) as se from line)), {STEPS})
"""))
def trend_test(spark, sf):
    return rounded(O.trend_test(millions(spark, sf), P.P1, H), 6)


@query("forecast_history", sql(f"""
select entity, period, {r('value', 6)} as value, 'Historical' as type from p1m
union all select entity, (last_t + k)::integer, {r('mv + b * (last_t + k - mt)', 6)}, 'Forecast' from line, {STEPS}
"""))
def forecast_history(spark, sf):
    df = materialise(millions(spark, sf).select("entity", "period", "value"), "p1")
    return rounded(O.bind_history(df, O.forecast_linear(df, P.P1, H), P.P1), 6)


cte("ets_points", """
select entity, row_number() over (partition by entity order by period) as i, period, value as y,
       count(*) over (partition by entity) as n, sum(value * value) over (partition by entity) as yy from p1m
""")
# The panel has at most so many periods, and the search so many rounds over a grid of so many weights.
POINTS, ROUNDS, GRID = 7, 3, 21
PRODUCTS = [(i, j) for i in range(3) for j in range(i, 3)]


def weights(centre: str, rnd: int) -> str:
    """The grid of one weight around a centre."""
    width = f"0.4999 * 0.1 ** {rnd}"
    return f"least(greatest({centre} - {width} + k * (2 * {width} / {GRID - 1}), 0.0001), 0.9999)"


def ets(x: str, trend: bool) -> None:
    """CTEs whose last, ``x``, has the best smoothing weights of every entity and what they lead to.

    The recursion is unrolled over the points for the data and the unit starts at once; the
    sums of products of the errors give the best start and its sum of squares.
    """
    ks = f"(select unnest(range({GRID})) as k)"
    for rnd in range(ROUNDS):
        at = f"{x}{rnd}"
        centre = ("0.5", "0.5", "ets_points where i = 1") if rnd == 0 else ("alpha", "beta", f"{x}{rnd - 1}_best")
        cte(f"{at}_alpha", f"select entity, n, yy, {weights(centre[0], rnd)} as alpha, {centre[1]} as middle from "
            + (f"{ks}, (select * from {centre[2]})" if rnd == 0 else f"{centre[2]}, {ks}"))
        beta = f"{weights('middle', rnd)}" if trend else "0.0"
        cte(f"{at}_0", f"select entity, n, yy, alpha, {beta} as beta, 0.0::double as l0, 0.0::double as s0, 1.0::double as l1, 0.0::double as s1, "
            f"0.0::double as l2, {float(trend)}::double as s2, " + ", ".join(f"0.0::double as g{i}{j}" for i, j in PRODUCTS)
            + ", " + ", ".join(f"0.0::double as m{i}" for i in range(3)) + f" from {at}_alpha" + (f", {ks}" if trend else ""))
        for i in range(1, POINTS + 1):
            cte(f"{at}_{i}", "select entity, n, yy, alpha, beta, "
                + ", ".join(f"if(y is null, l{c}, l{c} + s{c} + alpha * e{c}) as l{c}, if(y is null, s{c}, s{c} + beta * alpha * e{c}) as s{c}" for c in range(3))
                + ", " + ", ".join(f"g{a}{b} + coalesce(e{a} * e{b}, 0) as g{a}{b}" for a, b in PRODUCTS)
                + ", " + ", ".join(f"m{c} + coalesce(e{c}, 0) as m{c}" for c in range(3))
                + f" from (select r.*, y, y - l0 - s0 as e0, y * 0 - l1 - s1 as e1, y * 0 - l2 - s2 as e2 from {at}_{i - 1} as r"
                + f" left join ets_points as p on p.entity = r.entity and p.i = {i})")
        start = ("-((g22 + 1e-12) * g01 - g12 * g02) / ((g11 + 1e-12) * (g22 + 1e-12) - g12 * g12)",
                 "-((g11 + 1e-12) * g02 - g12 * g01) / ((g11 + 1e-12) * (g22 + 1e-12) - g12 * g12)") if trend else (
                 "-g01 / (g11 + 1e-12)", "0.0")
        cte(f"{at}_fit", f"""select entity, n, yy, alpha, beta, {rnd} as rnd, l0 + a * l1 + b * l2 as level, s0 + a * s1 + b * s2 as slope,
            m0 + a * m1 + b * m2 as total, sse, cast(printf('%.7e', sse + 1e-6 * yy) as double) as key
            from (select *, greatest(g00 + 2 * a * g01 + 2 * b * g02 + a * a * g11 + 2 * a * b * g12 + b * b * g22, 0) as sse
                  from (select *, {start[0]} as a, {start[1]} as b from {at}_{POINTS}))""")
        earlier = f" union all select * exclude (place) from {x}{rnd - 1}_best" if rnd else ""
        cte(f"{at}_best", f"""select * from (select *, row_number() over (partition by entity order by key, rnd, beta, alpha) as place
            from (select * from {at}_fit{earlier})) where place = 1""")
    cte(x, f"select b.*, last_t from {x}{ROUNDS - 1}_best as b join (select entity, max(period) as last_t from ets_points group by entity) using (entity)")


ets("ets_trend", True)
ets("ets_level", False)

ETS_SQL = f"""
select entity, k::integer as step, (last_t + k)::integer as period,
       {band_sql('(level + slope * k)', '(sqrt((sse - total * total / n) / (n - 1)) * sqrt(k))', 3)},
       'Exponential Smoothing (additive trend)' as model, true as success
from ets_trend, {STEPS}
"""
cte("aicc", f"""
select *, sqrt(sse / greatest(n - terms + 1, 1) * (1 + (k - 1) * (alpha * alpha + alpha * alpha * beta * k + (alpha * beta) ** 2 * k * (2 * k - 1) / 6))) as spread
from (select *, row_number() over (partition by entity order by n * ln(greatest(sse, 1e-300) / n) + 2 * terms + 2 * terms * (terms + 1) / (n - terms - 1), terms) as choice
      from (select *, 3 as terms, 'ETS(A,N,N)' as model from ets_level union all by name select *, 5 as terms, 'ETS(A,A,N)' as model from ets_trend)), {STEPS}
where choice = 1
""")


@query("forecast_ets", sql(ETS_SQL))
def forecast_ets(spark, sf):
    return rounded(O.forecast_ets(millions(spark, sf), P.P1, H), 3)


@query("forecast_auto", sql(ETS_SQL))
def forecast_auto(spark, sf):
    return rounded(O.forecast_auto(millions(spark, sf), P.P1, H), 3)


@query("forecast_auto_aicc", sql(f"""
select entity, k::integer as step, (last_t + k)::integer as period, {band_sql('(level + slope * k)', 'spread', 3)}, model, true as success from aicc
"""))
def forecast_auto_aicc(spark, sf):
    return rounded(O.forecast_auto(millions(spark, sf), P.P1, H, choose="aicc"), 3)


@query("forecast_models")
def forecast_models(spark, sf):
    """The best of six smoothing models for every nation by likelihood; tests compare them with a plain version."""
    return rounded(O.forecast_auto(millions(spark, sf), P.P1, H, choose="models"), 3)


@query("forecast_models_customers")
def forecast_models_customers(spark, sf):
    """The same for the yearly spending of every customer: as many series as customers, fitted together."""
    spent = P.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"), F.col("o_totalprice").alias("value"))
    yearly = spent.groupBy("entity", "period").agg((F.sum(F.floor(F.col("value") * 100 + 0.5)) / 100000).alias("value"))
    return rounded(O.forecast_auto(yearly, P.P1, H, choose="models"), 3)


@query("forecast_compare", sql(f"""
select entity, (aicc.last_t + k)::integer as period,
       {", ".join(f"{r(f'level + slope * k + {z} * spread', 3)} as ets_{c}" for c, z in (("yhat", "0"), ("lo80", "-1.28"), ("hi80", "1.28"), ("lo95", "-1.96"), ("hi95", "1.96")))},
       {r("mv + b * (line.last_t + k - mt)", 3)} as linear_yhat,
       {r(f"mv + b * (line.last_t + k - mt) - [{', '.join(map(str, T975))}][line.n - 2] * sqrt(line.sse / (line.n - 2)) * sqrt(1 + 1 / line.n + (line.last_t + k - mt) ** 2 / sxx)", 3)} as linear_lo95,
       {r(f"mv + b * (line.last_t + k - mt) + [{', '.join(map(str, T975))}][line.n - 2] * sqrt(line.sse / (line.n - 2)) * sqrt(1 + 1 / line.n + (line.last_t + k - mt) ** 2 / sxx)", 3)} as linear_hi95
from aicc join line using (entity)
"""))
def forecast_compare(spark, sf):
    return rounded(O.forecast_compare(materialise(millions(spark, sf), "p1"), P.P1, H), 3)


cte("xy", "select value as y, period as x1, population as x2, (entity = 'NATION_0')::int as x3 from p1m")
cte("centre", "select count(*) as n, avg(y) as my, avg(x1) as m1, avg(x2) as m2, avg(x3) as m3 from xy")
cte("moments", """
select any_value(n) as n, any_value(my) as my, any_value(m1) as m1, any_value(m2) as m2, any_value(m3) as m3, sum((y - my) ** 2) as yy,
       sum((x1 - m1) ** 2) as a, sum((x1 - m1) * (x2 - m2)) as b, sum((x1 - m1) * (x3 - m3)) as c, sum((x2 - m2) ** 2) as d,
       sum((x2 - m2) * (x3 - m3)) as e, sum((x3 - m3) ** 2) as f,
       sum((x1 - m1) * (y - my)) as y1, sum((x2 - m2) * (y - my)) as y2, sum((x3 - m3) * (y - my)) as y3
from xy, (select * from centre)
""")
cte("solved", """
select *, i11 * y1 + i12 * y2 + i13 * y3 as b1, i12 * y1 + i22 * y2 + i23 * y3 as b2, i13 * y1 + i23 * y2 + i33 * y3 as b3
from (select *, (d * f - e * e) / det as i11, (c * e - b * f) / det as i12, (b * e - c * d) / det as i13,
             (a * f - c * c) / det as i22, (b * c - a * e) / det as i23, (a * d - b * b) / det as i33
      from (select *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) as det from moments))
""")
cte("coefficients", """
select t.term, t.est, t.se, t.est / t.se as t, n - 4 as dof
from (select *, (yy - b1 * y1 - b2 * y2 - b3 * y3) / (n - 4) as s2 from solved), lateral (values
  ('period', b1, sqrt(s2 * i11)), ('population', b2, sqrt(s2 * i22)), ('is_focus', b3, sqrt(s2 * i33)),
  ('(Intercept)', my - b1 * m1 - b2 * m2 - b3 * m3, sqrt(s2 * (1 / n + m1 * (i11 * m1 + i12 * m2 + i13 * m3)
     + m2 * (i12 * m1 + i22 * m2 + i23 * m3) + m3 * (i13 * m1 + i23 * m2 + i33 * m3))))) as t(term, est, se)
""")


def with_limits(body: str, dofs: str) -> str:
    """``body`` beside the 95 percent point ``half_width`` of each ``dof`` of ``dofs``, by bisection, as the database has no t quantile either."""
    tail = tail_sql("atan((lo + hi) / 2 / sqrt(v))", "v")
    halved = f"""
bisect as (
select 0.0::double as lo, 2000.0::double as hi, 0 as i, dof as v from (select distinct dof from ({dofs}))
union all
select case when p > 0.05 then (lo + hi) / 2 else lo end, case when p > 0.05 then hi else (lo + hi) / 2 end, i + 1, v
from (select *, {tail} as p from bisect where i < 60)
),
limits as (select v as dof, (lo + hi) / 2 as half_width from bisect where i = 60)
"""
    body = body.strip()
    above = sql(body).removesuffix(body).strip()
    return (above.replace("with ", "with recursive ", 1) + "," if above else "with recursive") + halved + body


OLS_BODY = f"""
select term, {r('est', 4)} as estimate, {r('se', 4)} as std_error, {r('t', 4)} as statistic,
       {r(tail_sql('atan(abs(t) / sqrt(dof))', 'dof'), 4)} as p_value, dof,
       {r('est - half_width * se', 4)} as conf_low, {r('est + half_width * se', 4)} as conf_high
from coefficients join limits using (dof)
"""
OLS_SQL = with_limits(OLS_BODY, "select dof from coefficients")


@query("ols_coefficients", OLS_SQL)
def ols_query(spark, sf):
    """Revenue on year, customers and a flag, with standard errors and limits."""
    df = millions(spark, sf).withColumn("is_focus", (F.col("entity") == P.FOCUS).cast("double"))
    return rounded(ols_coefficients(materialise(df, "p1"), "value", ["period", "population", "is_focus"]), 4)


@query("ols_single", sql(f"""
select {r('b', 4)} as slope, {r('se', 4)} as std_error, n - 2 as dof
from (select regr_slope(value, population) as b, count(*) as n,
        sqrt((regr_syy(value, population) - regr_slope(value, population) * regr_sxy(value, population)) / (count(*) - 2) / regr_sxx(value, population)) as se
      from p1m)
"""))
def ols_single(spark, sf):
    """With one regressor the closed form is known, which checks the regression."""
    df = ols_coefficients(materialise(millions(spark, sf), "p1"), "value", ["population"])
    return rounded(df.where("term = 'population'").select(F.col("estimate").alias("slope"), "std_error", "dof"), 4)


# An aliased term has its name and the degrees of freedom, nothing else.
ALIASED_BODY = OLS_BODY.rstrip() + """
union all select term, null, null, null, null, dof, null, null from (select distinct dof from coefficients), (values ('twice'), ('constant')) as t(term)
"""


@query("ols_aliased", with_limits(ALIASED_BODY, "select dof from coefficients"))
def ols_aliased(spark, sf):
    """The same regression with a constant and a combination of two regressors, which change nothing but their own rows."""
    df = millions(spark, sf).withColumns({
        "is_focus": (F.col("entity") == P.FOCUS).cast("double"), "constant": F.lit(7.5),
        "twice": 2.0 * F.col("population") - 3 * F.col("period") + 1})
    return rounded(ols_coefficients(materialise(df, "p1"), "value", ["period", "constant", "population", "twice", "is_focus"]), 4)


cte("entity_lines", """
select entity, term, est, se, est / se as t, dof
from (select entity, b, mv - b * mt as base, n - 2 as dof, sqrt(sse / (n - 2) / sxx) as slope_se,
             sqrt(sse / (n - 2) * (1.0 / n + mt * mt / sxx)) as base_se from line),
     lateral (values ('period', b, slope_se), ('(Intercept)', base, base_se)) as t(term, est, se)
""")
BY_ENTITY_BODY = f"""
select entity, term, {r('est', 4)} as estimate, {r('se', 4)} as std_error, {r('t', 4)} as statistic,
       {r(tail_sql('atan(abs(t) / sqrt(dof))', 'dof'), 4)} as p_value, dof,
       {r('est - half_width * se', 4)} as conf_low, {r('est + half_width * se', 4)} as conf_high
from entity_lines join limits using (dof)
union all select entity, 'shifted', null, null, null, null, n - 2, null, null from line
"""


@query("ols_by_entity", with_limits(BY_ENTITY_BODY, "select dof from entity_lines"))
def ols_by_entity(spark, sf):
    """A line and an aliased copy of its regressor for every entity, all in one pass."""
    df = millions(spark, sf).withColumn("shifted", F.col("period") - 1990)
    return rounded(ols_coefficients(df, "value", ["period", "shifted"], min_rows=4, by=["entity"]), 4)


LINES_BODY = f"""
select {r('b', 4)} as slope, {r('se', 4)} as std_error, dof, {r('half_width', 9)} as half_width,
       {r('b - half_width * se', 4)} as conf_low, {r('b + half_width * se', 4)} as conf_high
from (select regr_slope(l_extendedprice, l_quantity) as b, count(*) - 2 as dof,
        sqrt((regr_syy(l_extendedprice, l_quantity) - regr_slope(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity))
             / (count(*) - 2) / regr_sxx(l_extendedprice, l_quantity)) as se
      from lineitem) join limits using (dof)
"""


@query("ols_lines", with_limits(LINES_BODY, "select count(*) - 2 as dof from lineitem"))
def ols_lines(spark, sf):
    """Price on quantity over all lines, with as many degrees of freedom as lines, where t is close to normal."""
    df = ols_coefficients(P.table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"]).where("term = 'l_quantity'")
    df = df.select(F.col("estimate").alias("slope"), "std_error", "dof", round_half_up(t_quantile(0.95, "dof"), 9).alias("half_width"),
                   "conf_low", "conf_high")
    return rounded(df, 4, skip=("half_width",))
