"""The feature build as data, and the function that runs it on any table with its columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from mensula.functions import columns as C
from mensula.operators import windows as W
from mensula.operators.profile import low_cardinality_columns
from mensula.operators.targets import churn_targets
from mensula.panel import Panel, columns_like, numeric_columns, require_columns, with_columns

TOTALS, DIFFERENCES, FLAGS, RATIOS = "totals", "differences", "flags", "ratios"
BUILDERS = {TOTALS: C.totals, DIFFERENCES: C.differences, FLAGS: C.flags, RATIOS: C.ratios}


@dataclass(frozen=True)
class Recipe:
    """What to derive, in order. Later steps may use columns of earlier ones. `include_current`: rolling values of this row too."""

    status_columns: Sequence[str] = ()
    date_triples: Sequence[tuple[str, str, str]] = ()
    card_brands: tuple[str, str] | None = None
    steps: Sequence[tuple[str, Mapping]] = ()
    not_expanded: Sequence[str] = ()
    few_values: int = 5
    lags: int = 2
    deltas: int = 2
    window: int = 3
    include_current: bool = False
    behaviour: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    inactive_flag: str | None = None
    trends: Sequence[str] = ()
    trend_window: int = 4
    accelerations: Sequence[str] = ()
    momenta: Sequence[str] = ()
    streaks: Mapping[str, str] = field(default_factory=dict)
    streak_window: int = 3
    times_since: Mapping[str, str] = field(default_factory=dict)


def _behaviour(panel: Panel, kind: str, column: str) -> Column:
    tests = {
        "not_positive": lambda: W.not_positive(column),
        "is_zero": lambda: W.is_zero(column),
        "is_positive": lambda: W.is_positive(column),
        "falling": lambda: W.falling(panel, column),
        "rising": lambda: W.rising(panel, column),
        "at_peak": lambda: W.at_peak(panel, column),
        "turned_on": lambda: W.turned_on(panel, column),
        "equals_one": lambda: C.F.col(column) == 1,
    }
    return C.flag(tests[kind]())


def row_features(df: DataFrame, panel: Panel, recipe: Recipe) -> tuple[DataFrame, list[str]]:
    """Row-wise part; also returns the columns the history part must not expand."""
    out = with_columns(df, *[C.one_hot(c, C.CARD_STATUS) for c in recipe.status_columns])
    out = out.drop(*recipe.status_columns)
    few = low_cardinality_columns(out, recipe.few_values) if recipe.few_values else []
    out = with_columns(out, C.latest_and_earliest(recipe.date_triples))
    dates = [f"{name}_{end}" for *_, name in recipe.date_triples for end in ("latest", "earliest")]
    out = out.drop(*[c for a, b, _ in recipe.date_triples for c in (a, b)])
    if recipe.card_brands:
        left, right = (columns_like(out, contains=b, without="status") for b in recipe.card_brands)
        out = with_columns(out, C.paired_sums(left, right, recipe.card_brands)).drop(*left, *right)
    out = with_columns(out, C.amount_count_ratios(out, exclude=panel.keys))
    for kind, spec in recipe.steps:
        out = with_columns(out, BUILDERS[kind](spec))
    return out, [*panel.keys, *recipe.not_expanded, *dates, *few]


def history_features(
    df: DataFrame, panel: Panel, recipe: Recipe, not_expanded: Sequence[str]
) -> DataFrame:
    """Windows in two levels over one shuffle and sort: plain columns, then flags and deltas."""
    expanded = numeric_columns(df, not_expanded)
    require_columns(df, [*recipe.trends, *recipe.momenta])
    behaviour = [_behaviour(panel, kind, c).alias(name) for name, (kind, c) in recipe.behaviour.items()]
    first = W.expand(
        df, panel, expanded, recipe.lags, recipe.deltas, recipe.window, also=behaviour, trends=recipe.trends,
        trend_window=recipe.trend_window, momenta=recipe.momenta, include_current=recipe.include_current)
    return with_columns(
        first,
        W.active_quarter(panel, recipe.inactive_flag) if recipe.inactive_flag else [],
        C.accelerations(first, recipe.accelerations),
        W.counted(panel, recipe.streaks, recipe.streak_window),
        W.time_since(panel, recipe.times_since),
    )


def build_features(df: DataFrame, panel: Panel, recipe: Recipe) -> DataFrame:
    """The whole feature table with both churn targets.

    Targets are found while rows are still narrow; everything shares one shuffle by entity.
    """
    rows, not_expanded = row_features(df, panel, recipe)
    labelled = churn_targets(rows, panel)
    targets = [c for c in labelled.columns if c not in rows.columns]
    out = history_features(labelled, panel, recipe, [*not_expanded, *targets])
    return out.select(*[c for c in out.columns if c not in targets], *targets)


# Key, column groups and output names of the bank customer panel.
BANK_PANEL = Panel("numero_de_cliente", "foto_mes")

BANK_RECIPE = Recipe(
    status_columns=("visa_status", "master_status"),
    date_triples=(
        ("Master_Finiciomora", "Visa_Finiciomora", "tc_finiciomora"),
        ("Master_Fvencimiento", "Visa_Fvencimiento", "tc_fvencimiento"),
        ("Master_fultimo_cierre", "Visa_fultimo_cierre", "tc_fultimocierre"),
        ("Master_fechaalta", "Visa_fechaalta", "tc_fechaalta"),
    ),
    card_brands=("visa", "master"),
    steps=(
        (TOTALS, {
            "deuda_total_prestamos": ("mprestamos_personales", "mprestamos_prendarios", "mprestamos_hipotecarios"),
            "prestamos_count_total": ("cprestamos_personales", "cprestamos_prendarios", "cprestamos_hipotecarios"),
            "plazo_fijo_total": ("mplazo_fijo_dolares", "mplazo_fijo_pesos"),
            "inversiones_monto_total": ("mplazo_fijo_dolares", "mplazo_fijo_pesos", "minversion1_pesos",
                                        "minversion1_dolares", "minversion2"),
            "inversiones_count_total": ("cplazo_fijo", "cinversion1", "cinversion2"),
            "seguros_total": ("cseguro_vida", "cseguro_auto", "cseguro_vivienda", "cseguro_accidentes_personales"),
            "payroll_monto_total": ("mpayroll", "mpayroll2"),
            "payroll_trx_total": ("cpayroll_trx", "cpayroll2_trx"),
            "pagos_servicios_count_total": ("cpagodeservicios", "cpagomiscuentas"),
            "pagos_servicios_monto_total": ("mpagodeservicios", "mpagomiscuentas"),
            "comisiones_count_total": ("ccomisiones_mantenimiento", "ccomisiones_otras"),
            "comisiones_monto_total": ("mcomisiones_mantenimiento", "mcomisiones_otras"),
            "transacciones_digitales_total": ("chomebanking_transacciones", "cmobile_app_trx"),
            "canales_digitales_activos": ("thomebanking", "tmobile_app"),
            "transacciones_cajas_total": ("ccajas_transacciones", "ccajas_consultas", "ccajas_depositos",
                                          "ccajas_extracciones", "ccajas_otras"),
            "atm_trx_total": ("catm_trx", "catm_trx_other"),
            "atm_monto_total": ("matm", "matm_other"),
            "cuentas_total": ("ccuenta_corriente", "ccaja_ahorro"),
            "saldo_pesos_total": ("mcuenta_corriente", "mcuenta_corriente_adicional", "mcaja_ahorro",
                                  "mcaja_ahorro_adicional"),
            "margen_total": ("mactivos_margen", "mpasivos_margen"),
            "actividad_inversora": ("cplazo_fijo", "cinversion1", "cinversion2", "cforex"),
        }),
        (DIFFERENCES, {
            "forex_balance": ("mforex_buy", "mforex_sell"),
            "transferencias_balance_count": ("ctransferencias_recibidas", "ctransferencias_emitidas"),
            "transferencias_balance_monto": ("mtransferencias_recibidas", "mtransferencias_emitidas"),
        }),
        (TOTALS, {
            "endeudamiento_total": ("msaldototal_tc", "deuda_total_prestamos"),
            "transacciones_totales": ("transacciones_digitales_total", "ccallcenter_transacciones",
                                      "transacciones_cajas_total", "atm_trx_total"),
            "activos_totales": ("mcuentas_saldo", "inversiones_monto_total"),
            "actividad_transaccional": ("ctransferencias_emitidas", "ctransferencias_recibidas",
                                        "cextraccion_autoservicio", "pagos_servicios_count_total"),
        }),
        (DIFFERENCES, {"patrimonio_neto": ("activos_totales", "endeudamiento_total")}),
        (FLAGS, {
            "tiene_cuenta_corriente": "ccuenta_corriente > 0",
            "tiene_caja_ahorro": "ccaja_ahorro > 0",
            "tiene_tc_activa": "master_status_abierta = 1 OR visa_status_abierta = 1",
            "tiene_prestamos": "prestamos_count_total > 0",
            "tiene_inversiones": "inversiones_count_total > 0",
            "tiene_seguros": "seguros_total > 0",
            "tiene_payroll": "payroll_trx_total > 0",
            "tc_en_cierre": "master_status_pcierre = 1 OR visa_status_pcierre = 1 "
                            "OR master_status_pacierre = 1 OR visa_status_pacierre = 1",
            "tiene_tc_cerrada": "master_status_cerrada = 1 OR visa_status_cerrada = 1",
        }),
        (TOTALS, {
            "diversificacion_productos": ("tiene_cuenta_corriente", "tiene_caja_ahorro", "tiene_tc_activa",
                                          "tiene_prestamos", "tiene_inversiones", "tiene_seguros"),
        }),
        (RATIOS, {
            "ratio_endeudamiento_vs_saldo": ("endeudamiento_total", "mcuentas_saldo"),
            "ratio_saldo_tc_vs_limite": ("msaldototal_tc", "mlimitecompra_tc"),
            "ratio_consumo_tc_vs_limite": ("mconsumototal_tc", "mlimitecompra_tc"),
            "ratio_pagos_vs_consumo_tc": ("mpagado_tc", "mconsumototal_tc"),
            "ratio_pagado_vs_minimo_tc": ("mpagado_tc", "mpagominimo_tc"),
            "ratio_adelantos_vs_consumo_tc": ("madelantopesos_tc", "mconsumototal_tc"),
            "ratio_inversiones_vs_saldo": ("inversiones_monto_total", "mcuentas_saldo"),
            "ratio_inversiones_vs_activos": ("inversiones_monto_total", "activos_totales"),
        }),
    ),
    not_expanded=("cliente_edad", "cliente_antiguedad"),
    few_values=5,
    lags=2,
    deltas=2,
    window=3,
    behaviour={
        "flag_rentabilidad_negativa": ("not_positive", "mrentabilidad"),
        "flag_saldo_decreciente": ("falling", "mcuentas_saldo"),
        "flag_sin_consumo_tc": ("is_zero", "mconsumototal_tc"),
        "flag_sin_transacciones_digital": ("is_zero", "transacciones_digitales_total"),
        "flag_inactivo": ("is_zero", "transacciones_totales"),
        "flag_perdiendo_productos": ("falling", "cproductos"),
        "flag_sin_payroll": ("is_zero", "payroll_trx_total"),
        "flag_tc_en_cierre": ("equals_one", "tc_en_cierre"),
        "flag_endeudamiento_creciente": ("rising", "endeudamiento_total"),
        "flag_desinvirtiendo": ("falling", "inversiones_monto_total"),
        "flag_consumo_tc": ("is_positive", "mconsumototal_tc"),
        "flag_trx_digital": ("is_positive", "transacciones_digitales_total"),
        "flag_payroll": ("is_positive", "payroll_trx_total"),
        "flag_plazo_fijo": ("is_positive", "cplazo_fijo"),
        "flag_inversion": ("is_positive", "inversiones_count_total"),
        "flag_pico_saldo": ("at_peak", "mcuentas_saldo"),
        "flag_pico_productos": ("at_peak", "cproductos"),
        "flag_pico_rentabilidad": ("at_peak", "mrentabilidad"),
        "flag_cambio_status_tc": ("turned_on", "tc_en_cierre"),
    },
    inactive_flag="flag_inactivo",
    trends=(
        "mrentabilidad", "mcuentas_saldo", "mconsumototal_tc", "cproductos", "transacciones_digitales_total",
        "payroll_monto_total", "inversiones_monto_total", "endeudamiento_total", "margen_total", "cuentas_total",
        "seguros_total", "diversificacion_productos", "actividad_transaccional", "actividad_inversora",
        "comisiones_monto_total", "ratio_endeudamiento_vs_saldo", "ratio_consumo_tc_vs_limite",
        "ratio_pagos_vs_consumo_tc", "ratio_inversiones_vs_saldo",
    ),
    trend_window=4,
    accelerations=("mrentabilidad", "mcuentas_saldo", "mconsumototal_tc", "cproductos",
                   "transacciones_digitales_total", "payroll_monto_total"),
    momenta=("mrentabilidad", "mcuentas_saldo", "mconsumototal_tc", "transacciones_digitales_total",
             "inversiones_monto_total", "payroll_monto_total", "cproductos"),
    streaks={
        "streak_rentabilidad_negativa_3m": "flag_rentabilidad_negativa = 1",
        "streak_saldo_decreciente_3m": "flag_saldo_decreciente = 1",
        "streak_sin_consumo_tc_3m": "flag_sin_consumo_tc = 1",
        "streak_sin_transacciones_digital_3m": "flag_sin_transacciones_digital = 1",
        "streak_inactivo_3m": "flag_inactivo = 1",
        "streak_perdiendo_productos_3m": "flag_perdiendo_productos = 1",
        "streak_sin_payroll_3m": "flag_sin_payroll = 1",
        "streak_tc_en_cierre_3m": "flag_tc_en_cierre = 1",
        "streak_endeudamiento_creciente_3m": "flag_endeudamiento_creciente = 1",
        "streak_desinvirtiendo_3m": "flag_desinvirtiendo = 1",
    },
    streak_window=3,
    times_since={
        "meses_desde_ultimo_consumo_tc": "flag_consumo_tc = 1",
        "meses_desde_ultima_trx_digital": "flag_trx_digital = 1",
        "meses_desde_ultimo_payroll": "flag_payroll = 1",
        "meses_desde_ultimo_plazo_fijo": "flag_plazo_fijo = 1",
        "meses_desde_ultima_inversion": "flag_inversion = 1",
        "meses_desde_cancelacion_producto": "flag_perdiendo_productos = 1",
        "meses_desde_pico_saldo": "flag_pico_saldo = 1",
        "meses_desde_pico_productos": "flag_pico_productos = 1",
        "meses_desde_pico_rentabilidad": "flag_pico_rentabilidad = 1",
        "meses_desde_cambio_status_tc": "flag_cambio_status_tc = 1",
    },
)
