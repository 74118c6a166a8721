"""Broker histories -> final tables -> one consolidated table with commission."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.numbers import commission, plan_code
from rosterflow.functions.periods import prior_period, trailing_period, valid_period

FILE_KEY = "Nombre_de_archivo"
# Columns of the consolidated table, in order, before the commission.
TOTAL_COLUMNS = (
    "MES_Recaudacion", "POLIZA", "foliocredito", "rutafiliado", "MontoBruto", "Plazo",
    "fechaPrimerVto", "FechaUltimoVto", "ValorCuota", "FechaPrima", "Producto",
    "FolioOrigen", "FechaOrigen", "PLAN_TECNICO", "PLAZO_CUOTAS", "Negocio",
    "PrimaBruta", "PrimaNeta",
)
BUSINESS = "Credito Consumo"


@dataclass(frozen=True)
class Broker:
    """What tags a broker's rows: its policy and plan (or the plan text), and its column names."""

    policy: int | None = None
    plan: int | None = None
    instalments: int = 4
    by_plan_text: str | None = None
    one_month_late: bool = False
    renames: Mapping[str, str] = field(default_factory=dict)


# Policy, technical plan and column names of each broker.
BROKERS = {
    "marsh": Broker(plan=8285, one_month_late=True, renames={"Prima_Bruta_mensual": "PrimaBruta", "Prima_Neta": "PrimaNeta"}),
    "conosur": Broker(plan=6832, renames={"PrimaBrutaMensual": "PrimaBruta", "PrimaNetaMensual": "PrimaNeta"}),
    "flujo2": Broker(policy=5698774, plan=6270),
    "flujo": Broker(policy=4659577, plan=4277),
    "stock": Broker(policy=4668266, plan=4277),
    "planes": Broker(by_plan_text="Planes"),
}


def file_period(key: Column, broker: Broker) -> Column:
    """The period a file's premiums belong to, told by its name; null for names without one."""
    period = valid_period(trailing_period(key))
    return prior_period(period) if broker.one_month_late else period


def final_table(history: DataFrame, broker: Broker) -> DataFrame:
    """History plus period, policy, plan, instalments and business; periods that are none become null."""
    tags: dict[str, Column] = {"MES_Recaudacion": file_period(F.col(FILE_KEY), broker), "Negocio": F.lit(BUSINESS)}
    if broker.by_plan_text:
        text = F.col(broker.by_plan_text)
        tags |= {
            "POLIZA": plan_code(text, "policy"),
            "PLAN_TECNICO": plan_code(text, "plan"),
            "PLAZO_CUOTAS": plan_code(text, "instalments"),
        }
    else:
        tags |= {"PLAN_TECNICO": F.lit(broker.plan), "PLAZO_CUOTAS": F.lit(broker.instalments)}
        if broker.policy is not None:
            tags["POLIZA"] = F.lit(broker.policy)
    return history.withColumns(tags)


# Types of the consolidated table where the brokers differ (whole or decimal amounts, text keys).
_TYPES = {
    "MES_Recaudacion": "int", "POLIZA": "bigint", "foliocredito": "bigint", "rutafiliado": "bigint",
    "MontoBruto": "double", "Plazo": "bigint", "fechaPrimerVto": "bigint", "FechaUltimoVto": "bigint",
    "ValorCuota": "double", "FechaPrima": "bigint", "Producto": "string", "FolioOrigen": "bigint",
    "FechaOrigen": "bigint", "PLAN_TECNICO": "int", "PLAZO_CUOTAS": "int", "Negocio": "string",
    "PrimaBruta": "double", "PrimaNeta": "double",
}


def consolidated(finals: Mapping[str, DataFrame], brokers: Mapping[str, Broker] = BROKERS) -> DataFrame:
    """One row per row of every final table, common columns only, commission zero.

    Only the common columns are read from each history; a column a broker lacks
    is null.
    """
    parts = []
    for name, final in finals.items():
        named = final.withColumnsRenamed(dict(brokers[name].renames))
        have = {c.lower() for c in named.columns}
        parts.append(
            named.select(
                *[
                    (F.col(c) if c.lower() in have else F.lit(None)).cast(_TYPES[c]).alias(c)
                    for c in TOTAL_COLUMNS
                ]
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("Comision", F.lit(0.0))


def with_commission(total: DataFrame) -> DataFrame:
    """Commission by technical plan; other plans keep what they have."""
    return total.withColumn("Comision", commission(F.col("PLAN_TECNICO"), F.col("PrimaNeta"), F.col("Comision")))


def consolidate(histories: Mapping[str, DataFrame], brokers: Mapping[str, Broker] = BROKERS) -> DataFrame:
    """Histories to the consolidated table with commission, as one plan without a shuffle."""
    finals = {name: final_table(df, brokers[name]) for name, df in histories.items()}
    return with_commission(consolidated(finals, brokers))
