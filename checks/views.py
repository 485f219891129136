"""The fixtures of `checks.fixtures`, defined a second time in SQL."""

from checks.fixtures import EVENT_TYPES, RETURN_FLAGS


def _per_event() -> str:
    return ", ".join(
        f"cast(count(case when event_type = '{t}' then 1 end) as bigint) as c{t}, "
        f"cast(sum(case when event_type = '{t}' then cast(round(value * 100) as bigint) end) as bigint) as m{t}"
        for t in EVENT_TYPES
    )


def _per_flag() -> str:
    hit = "case when l_returnflag = '{f}' then {v} end"
    ship = "cast(strftime(l_shipdate, '%Y%m%d') as integer)"
    parts = []
    for f in RETURN_FLAGS:
        parts += [
            f"cast(sum({hit.format(f=f, v='cast(round(l_extendedprice * 100) as bigint)')}) as bigint) as {f}_amount",
            f"cast(sum({hit.format(f=f, v='cast(l_quantity as bigint)')}) as bigint) as {f}_qty",
            f"min({hit.format(f=f, v=ship)}) as {f}_first",
            f"max({hit.format(f=f, v=ship)}) as {f}_last",
        ]
    return ", ".join(parts)


VIEWS = {
    "p_ud": f"""select user_id as c, cast(strftime(ts, '%Y%m%d') as integer) as m,
        count(*) as n_all, {_per_event()} from events group by 1, 2""",
    "p_cm": """select o_custkey as c, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as m,
        count(*) as n_orders,
        cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as m_total,
        max(cast(round(o_totalprice * 100) as bigint)) as m_max,
        count(case when o_orderstatus = 'O' then 1 end) as c_open,
        count(case when o_orderstatus = 'F' then 1 end) as c_final,
        count(case when o_orderstatus = 'P' then 1 end) as c_pending
        from orders group by 1, 2""",
    "p_sm": f"""select l_suppkey as c, cast(year(l_shipdate) * 100 + month(l_shipdate) as integer) as m,
        {_per_flag()} from lineitem group by 1, 2""",
    "s_long": """select o_orderkey as entity, cast(study as integer) as study, cast(seed as integer) as seed,
        ((o_orderkey * 7919 + study * 101 + seed * 13) % 10007) / 10007.0::double as proba,
        cast(o_orderstatus = 'F' as integer) as y, cast(year(o_orderdate) as integer) as period
        from orders, (select unnest(range(3)) as study) a, (select unnest(range(2)) as seed) b""",
    "l_doc": "select l.doc_id, quality, toxic, n_chars from labels l join documents d on l.doc_id = d.doc_id",
    "d_pair": """select case when year(l_shipdate) <= 1998 then 'expected' else 'actual' end as sample,
        l_extendedprice as price, l_quantity as quantity, l_discount as discount,
        nullif(l_discount, 0) as discount_known, l_returnflag as flag
        from lineitem""",
}


def sql(view: str, select: str, *more: str) -> str:
    """`select` with the named views (and extra `name as (...)` parts) in front."""
    parts = [f"{v} as ({VIEWS[v]})" for v in view.split()] + list(more)
    return f"with {', '.join(parts)} {select}"
