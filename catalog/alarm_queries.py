"""Control-chart alarms on daily events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import panels as P
from catalog.registry import query, rounded
from catalog.sql import r, sql
from panelkit.functions import classify as C
from panelkit.operators import alarm

CENTRAL = "(partition by category order by period rows between 2 preceding and 2 following)"
TRAILING = "(partition by category order by period rows between 5 preceding and 1 preceding)"


def _days(df):
    return df.withColumn("period", F.col("period").cast("string"))


@query("outbreak_signal", sql(f"""
select category, period::varchar as period, {r(f'avg(value) over {CENTRAL} + 2 * stddev_pop(value) over {CENTRAL}')} as threshold,
       value > avg(value) over {CENTRAL} + 2 * stddev_pop(value) over {CENTRAL} as central_signal,
       coalesce(value > avg(value) over {TRAILING} + 2 * stddev_pop(value) over {TRAILING}
         and count(value) over {TRAILING} >= 5, false) as trailing_signal
from p2
"""))
def outbreak_signal(spark, sf):
    """The central rule, which includes the tested day, and the trailing rule."""
    df = P.p2(spark, sf)
    return rounded(_days(df.select(
        "category", "period", alarm.outbreak_threshold(P.P2).alias("threshold"),
        alarm.outbreak_signal(P.P2).alias("central_signal"),
        alarm.outbreak_signal(P.P2, baseline="trailing").alias("trailing_signal"))))


def z_sql(frame: str) -> str:
    return (f"case when stddev_pop(value) over {frame} > 0 then "
            f"{r(f'(value - avg(value) over {frame}) / stddev_pop(value) over {frame}', 2)} else 0.0::double end")


@query("outbreak_zscore", sql(f"""
select category, period::varchar as period, {z_sql(CENTRAL)} as z_central, {z_sql(TRAILING)} as z_trailing from p2
"""))
def outbreak_zscore(spark, sf):
    return _days(P.p2(spark, sf).select(
        "category", "period", alarm.outbreak_zscore(P.P2).alias("z_central"),
        alarm.outbreak_zscore(P.P2, baseline="trailing").alias("z_trailing")))


@query("outbreak_status", sql(f"""
select category, period::varchar as period,
       case when sig and z >= 3 then 'Severe Outbreak' when sig then 'Outbreak Detected' when z >= 1 then 'Elevated' else 'Normal Range' end as status
from (select category, period, {z_sql(TRAILING)} as z,
        coalesce(value > avg(value) over {TRAILING} + 2 * stddev_pop(value) over {TRAILING}
          and count(value) over {TRAILING} >= 5, false) as sig from p2)
"""))
def outbreak_status(spark, sf):
    df = P.p2(spark, sf).withColumns({
        "z": alarm.outbreak_zscore(P.P2, baseline="trailing"),
        "signal": alarm.outbreak_signal(P.P2, baseline="trailing")})
    return _days(df.select("category", "period", C.outbreak_status("signal", "z").alias("status")))
