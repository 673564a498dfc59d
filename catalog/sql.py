"""Pieces of SQL shared by the checking queries."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, text: str) -> None:
    CTES[name] = text.strip()


def sql(body: str) -> str:
    """Put the common table expressions that ``body`` names in front of it."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b(?:from|join)\s+{name}\b", text):
                if name not in wanted:
                    visit(CTES[name])
                    if name not in wanted:
                        wanted.append(name)

    visit(body)
    if not wanted:
        return body.strip()
    return "with " + ",\n".join(f"{n} as (\n{CTES[n]}\n)" for n in wanted) + "\n" + body.strip()


def r(expr: str, digits: int = 4) -> str:
    """Round half away from zero on the 15 significant digits of a double."""
    return f"cast({exact(expr, digits)} as double)"


def exact(expr: str, digits: int) -> str:
    """As ``r``, but as a decimal."""
    return f"cast(printf('%.14e', cast({expr} as double)) as decimal(38,{digits}))"


cte("p1", """
select n_name as entity, cast(year(o_orderdate) as integer) as period,
       cast(sum(cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint)) as bigint) as cents,
       count(*) as n_rows, count(distinct o_custkey) as population,
       cast(sum(cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint)) as double) / 100 as value
from lineitem join orders on l_orderkey = o_orderkey
     join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by 1, 2
""")
cte("pt", """
select entity, period, cents, n_rows, population, value from p1
union all
select 'ALL', period, cast(sum(cents) as bigint), cast(sum(n_rows) as bigint), cast(sum(population) as bigint),
       cast(sum(cents) as double) / count(*) / 100
from p1 group by period
""")
cte("dim", "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey")
cte("p2", """
select event_type as category, cast(ts as date) as period, count(*) as n,
       cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents, cast(count(*) as double) as value
from events group by 1, 2
""")
cte("p2r", """
select r_name, event_type, cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as integer) as period, count(*) as n
from events join customer on user_id = c_custkey join dim on c_nationkey = n_nationkey
group by 1, 2, 3
""")
cte("p3", """
select r_name as entity, c_mktsegment as substance, o_orderpriority as harm,
       cast(year(o_orderdate) as integer) as period,
       cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents, count(*) as n_rows,
       cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 100 as value
from orders join customer on o_custkey = c_custkey join dim on c_nationkey = n_nationkey
group by 1, 2, 3, 4
""")
cte("p4", """
select cast(year(l_shipdate) as integer) as period, l_linestatus as category, l_returnflag as stratum,
       count(*) as n, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents
from lineitem group by 1, 2, 3
""")
cte("p5", """
select '  ' || entity || ' ' as geo,
       case when period = 2001 then '2001 (Jan to Aug)'
            when period % 2 = 0 then cast(period as varchar) || '*'
            else cast(period as varchar) || '–' || cast(period + 1 as varchar) end as time_frame,
       case when n_rows % 7 = 0 then 'Suppr.' when n_rows % 11 = 0 then '-'
            when n_rows % 13 = 0 then null else format('{:,}', cents) end as value,
       entity, period, cents, n_rows, population
from p1
""")
cte("p6", """
select *, 'series' as source from p1
union all select *, 'snapshot' from p1 where period in (1995, 1997, 1999)
""")
