"""The feature recipe run end to end on a bank-shaped panel, checked on its last columns."""

from pyspark.sql import functions as F

from checks.views import sql
from checks import fixtures as fx
from mensula.functions.columns import CARD_STATUS, amount_count_pairs
from mensula.plans.recipes import BANK_PANEL, BANK_RECIPE, build_features

R = BANK_RECIPE
EXTRA = ("patrimonio_neto_lag_1", "forex_balance_delta_2", "tiene_prestamos_max_3", "atm_monto_total_min_3",
         "tc_fechaalta_latest", "tc_fechaalta_earliest")
SHARES = ("ratio_mpayroll2_cpayroll2", "ratio_matm_catm")
ROUNDED = ([f"{c}_trend_4" for c in R.trends], [f"{c}_momentum" for c in R.momenta])
WHOLE = [*EXTRA, *R.behaviour, "active_quarter", *[f"{c}_accel" for c in R.accelerations], *R.streaks, *R.times_since,
         "target_binario", "target_ternario"]


def digits(name):
    """Slopes of amounts are large and end early; slopes of ratios are small."""
    return 10 if name.startswith("ratio") else 3


def late_features(spark, sf):
    out = build_features(fx.bank_months(spark, sf, R), BANK_PANEL, R)
    return out.select(*BANK_PANEL.keys, *WHOLE, *[F.round(c, digits(c)).alias(c) for c in ROUNDED[0]],
                      *[F.round(c, 6).alias(c) for c in ROUNDED[1]])


_cards = {f"{brand}_{m}" for m in fx.CARD_MEASURES for brand in ("Visa", "Master")}
_dates = {c for a, b, _ in R.date_triples for c in (a, b)}
MEASURES = [c for c in fx.bank_columns(R) if c not in _cards | _dates | set(R.not_expanded)] + [f"{m}_tc" for m in fx.CARD_MEASURES]
PAIRS = amount_count_pairs(MEASURES)
EXPANDED = [*MEASURES, *[f"ratio_{m}_{c}" for m, c in PAIRS], *[n for _, spec in R.steps for n in spec]]
FAMILIES = ("", "_lag_1", "_lag_2", "_delta_1", "_delta_2", "_max_3", "_min_3", "_avg_3")
EVERY = [f"{c}{family}" for c in EXPANDED for family in FAMILIES]


def all_features(spark, sf):
    """Filled cells and total of every measure and of everything expanded from it."""
    out = build_features(fx.bank_months(spark, sf, R), BANK_PANEL, R)
    families = [c for c in out.columns if c.endswith(FAMILIES[1:])]
    assert set(families) <= set(EVERY), sorted(set(families) - set(EVERY))
    cells = out.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in EVERY])).alias("i", "v"))
    names = F.array(*[F.lit(c) for c in EVERY])
    return cells.groupBy("i").agg(F.count("v").alias("n_filled"), F.round(F.sum("v"), 4).alias("total")).select(
        F.get(names, F.col("i")).alias("feature"), "n_filled", "total")


def _raw():
    parts = []
    for i, name in enumerate(fx.bank_columns(R)):
        # both engines keep the sign of the dividend out: all terms are non-negative
        value = f"((c * {i + 11} + m::bigint * {i % 5 + 3} + n_all * {i + 5}) % {40 + i} - {i % 7 * 4})"
        value = f"{value} / 4.0::double" if name.startswith(("m", "Visa", "Master")) else value
        parts.append(f"case when (c + m + {i}) % 13 <> 0 then {value} end as {name}")
    for i, name in enumerate(R.status_columns):
        parts.append(f"case (c + (m // 2) * {i + 1}) % 5 when 0 then 0 when 1 then 6 when 2 then 7 when 3 then 9 end as {name}")
    return f"raw as (select c as numero_de_cliente, m as foto_mes, {', '.join(parts)} from p_ud)"


def _card():
    hot = [f"case when {s} = {k} then 1 else 0 end as {s}_{v}" for s in R.status_columns for k, v in CARD_STATUS.items()]
    pairs = [f"coalesce(Visa_{m}, 0) + coalesce(Master_{m}, 0) as {m}_tc" for m in fx.CARD_MEASURES]
    dates = [f"cast(greatest({a}, {b}) as integer) as {n}_latest, cast(least({a}, {b}) as integer) as {n}_earliest"
             for a, b, n in R.date_triples]
    return f"s0 as (select *, {', '.join(hot + pairs + dates)} from raw)"


def _step(kind, spec):
    if kind == "totals":
        return [" + ".join(f"coalesce(cast({c} as bigint), 0)" for c in cs) + f" as {n}" for n, cs in spec.items()]
    if kind == "differences":
        return [f"coalesce({a}, 0) - coalesce({b}, 0) as {n}" for n, (a, b) in spec.items()]
    if kind == "flags":
        return [f"case when {t} then 1 else 0 end as {n}" for n, t in spec.items()]
    return [f"cast({a} as double) / nullif({b}, 0) as {n}" for n, (a, b) in spec.items()]


FLAG_SQL = {
    "not_positive": "{0} <= 0", "is_zero": "coalesce({0}, 0) = 0", "is_positive": "coalesce({0}, 0) > 0",
    "falling": "{0} < lag({0}) over w", "rising": "{0} > lag({0}) over w", "at_peak": "{0} = max({0}) over w",
    "turned_on": "{0} = 1 and lag({0}) over w = 0", "equals_one": "{0} = 1",
}


def _steps():
    """CTEs up to all row-wise columns, and the name of the last one."""
    parts = [_raw(), _card()]
    for i, (kind, spec) in enumerate(R.steps):
        parts.append(f"s{i + 1} as (select *, {', '.join(_step(kind, spec))} from s{i})")
    return parts, f"s{len(R.steps)}"


def all_sql():
    parts, last = _steps()
    key, time = BANK_PANEL.keys
    shares = [f"{m} / (c0 + 0.01::double) as ratio_{m}_{c}".replace("c0", c) for m, c in PAIRS]
    parts.append(f"base as (select {key}, {time}, {', '.join(f'cast({c} as double) as {c}' for c in EXPANDED if not c.startswith('ratio_m'))}, "
                 f"{', '.join(shares)} from {last})")
    cells = []
    for c in EXPANDED:
        cells += [c, f"lag({c}, 1) over w", f"lag({c}, 2) over w", f"{c} - lag({c}, 1) over w", f"{c} - lag({c}, 2) over w",
                  f"max({c}) over p3", f"min({c}) over p3", f"avg({c}) over p3"]
    part = f"partition by {key} order by {time}"
    parts.append(f"cells as (select {', '.join(f'{cell} as v{i}' for i, cell in enumerate(cells))} from base window w as ({part}), "
                 f"p3 as ({part} rows between 3 preceding and 1 preceding))")
    rows = ", ".join(f"struct_pack(f := '{name}', n := count(v{i}), t := round(sum(v{i}), 4))" for i, name in enumerate(EVERY))
    return sql("p_ud", f"select r.f as feature, r.n as n_filled, r.t as total from (select unnest([{rows}]) as r from cells)", *parts)


def late_sql():
    parts, last = _steps()
    key, time = BANK_PANEL.keys
    flags = [f"case when {FLAG_SQL[k].format(c)} then 1 else 0 end as {n}" for n, (k, c) in R.behaviour.items()]
    parts.append(f"fl as (select *, {', '.join(flags)}, row_number() over w as ri from {last} "
                 f"window w as (partition by {key} order by {time}))")
    late = [
        "lag(patrimonio_neto, 1) over w as patrimonio_neto_lag_1",
        "forex_balance - lag(forex_balance, 2) over w as forex_balance_delta_2",
        "max(tiene_prestamos) over p3 as tiene_prestamos_max_3", "min(atm_monto_total) over p3 as atm_monto_total_min_3",
        "tc_fechaalta_latest", "tc_fechaalta_earliest", *R.behaviour,
        "cast(count(case when flag_inactivo = 0 then 1 end) over c3 as bigint) as active_quarter",
        *[f"({c} - lag({c}, 1) over w) - ({c} - lag({c}, 2) over w) as {c}_accel" for c in R.accelerations],
        *[f"cast(count(case when {t} then 1 end) over c3 as bigint) as {n}" for n, t in R.streaks.items()],
        *[f"{time} - max(case when {t} then {time} end) over w as {n}" for n, t in R.times_since.items()],
        *[f"round(case when isnan(regr_slope({c}, ri) over p4) then null else regr_slope({c}, ri) over p4 end, {digits(c)}) as {c}_trend_4"
          for c in R.trends],
        *[f"round(avg({c}) over c2 / nullif(avg({c}) over past, 0), 6) as {c}_momentum" for c in R.momenta],
    ]
    part = f"partition by {key} order by {time}"
    parts.append(f"""late as (select {key}, {time}, {', '.join(late)} from fl window w as ({part}),
        p3 as ({part} rows between 3 preceding and 1 preceding), p4 as ({part} rows between 4 preceding and 1 preceding),
        c3 as ({part} rows between 2 preceding and current row), c2 as ({part} rows between 1 preceding and current row),
        past as ({part} rows between 5 preceding and 2 preceding))""")
    parts.append("""ahead as (select c, m, here, lead(here, 1) over w as h1, lead(here, 2) over w as h2 from
        (select who.c, times.m, p.c is not null as here from (select distinct c from p_ud) who
         cross join (select distinct m from p_ud) times left join p_ud p on p.c = who.c and p.m = times.m)
        window w as (partition by c order by m))""")
    return sql("p_ud", f"""select late.*, case when not h1 or not h2 then 1 else 0 end as target_binario,
        case when h1 and not h2 then 1 else 0 end as target_ternario
        from late join ahead on ahead.c = late.{key} and ahead.m = late.{time} where here""", *parts)


CHECKS = {
    "recipe_late_features": (late_features, late_sql()),
    "recipe_all_features": (all_features, all_sql()),
}
