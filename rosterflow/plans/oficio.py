"""The regulator report: vigency and insured amount per policy item."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.numbers import insured_amount, vigency
from rosterflow.functions.periods import period_of
from rosterflow.operators.relational import delete_where, skew_left_join
from rosterflow.plans.consolidation import BROKERS, Broker, file_period
from rosterflow.sinks.versioned import History

# Constants of the report.
DOCUMENT_TYPE = 1
PERIODICITY = 3
PAYMENT_TYPE = 9
SUBDIVISION = "3B"
REGULATOR_BRANCH = 33
ITEM_KEYS = (
    "COD_TIPO_DOCUMENTO_ASEGURADO", "RUT", "NNUMDOCU", "NNUMITEM", "PLAN_TECNICO", "COD_RAMO",
    "COD_PERIODICIDAD_PAGO", "COD_TIPO_PAGO",
)


@dataclass(frozen=True)
class ReportPeriod:
    """Cut-off and vigency months; the special policies have their own."""

    suffix: str
    cutoff: int
    special_cutoff: int
    vigency: int
    special_vigency: int
    special_policies: tuple[int, ...]


@dataclass(frozen=True)
class Reporter:
    """Who reports, and on whose behalf; taken from the job's configuration."""

    company_number: int
    company_digit: int
    company_name: str
    contractor_number: int
    contractor_digit: int


def report_base(monitoring: DataFrame) -> DataFrame:
    """Coverage rows (rows without a coverage group leave too) in the report's own names."""
    return monitoring.where(F.col("COBERTURA_AGRUP") != "TOTAL").select(
        period_of(F.col("NANOPROC"), F.col("NMESPROC")).cast("int").alias("mes_referencia"),
        F.lit(DOCUMENT_TYPE).alias("COD_TIPO_DOCUMENTO_ASEGURADO"),
        F.col("NNUMCERT").alias("RUT"),
        F.col("NNUMDOCU").cast("bigint").alias("NNUMDOCU"),
        "NNUMITEM",
        F.col("PLAN_TECNICO").cast("int").alias("PLAN_TECNICO"),
        F.col("NCORASVS").cast("int").alias("COD_RAMO"),
        "PRIMA_UF",
        F.lit(PERIODICITY).alias("COD_PERIODICIDAD_PAGO"),
        F.lit(PAYMENT_TYPE).alias("COD_TIPO_PAGO"),
    )


def apply_cutoff(base: DataFrame, period: ReportPeriod) -> DataFrame:
    """Delete what is older than its rule's month; rows with an unknown policy or month stay."""
    special = F.col("NNUMDOCU").isin(*period.special_policies)
    old = F.col("mes_referencia") < F.when(special, period.special_cutoff).otherwise(period.cutoff)
    return delete_where(base, F.col("NNUMDOCU").isNotNull() & old)


def reported_files(files: DataFrame, broker: Broker, period_map: DataFrame, period: ReportPeriod) -> DataFrame:
    """Those of ``files (key)`` that may hold rows the cut-off keeps.

    One row per file, so the premiums need not be looked at.  Files without a
    period, or with one the calendar does not know, may.
    """
    first = min(period.cutoff, period.special_cutoff)
    month = period_of(F.year("PER_ANT"), F.month("PER_ANT"))
    known = period_map.select(F.col("MES_REF").alias("_month"), month.alias("_reported"))
    dated = files.select("key", file_period(F.col("key"), broker).alias("_period"))
    return dated.join(known, F.col("_period") == F.col("_month"), "left").where(
        F.col("_reported").isNull() | (F.col("_reported") >= first)
    ).select("key").distinct()


def reported_histories(
    stores: Mapping[str, History], period_map: DataFrame, period: ReportPeriod, brokers: Mapping[str, Broker] = BROKERS
) -> dict[str, DataFrame]:
    """Each broker's history, of which only the folders that the report can need are read.

    Rows without a policy in older files are not among them; they have no coverage
    group, so that the report leaves them out in any case.
    """
    return {
        name: store.read(keys=reported_files(store.manifest().select("key").distinct(), brokers[name], period_map, period))
        for name, store in stores.items()
    }


def rollup(base: DataFrame) -> DataFrame:
    """Per item: the last month and the premium summed (map-side combined)."""
    return base.groupBy(*ITEM_KEYS).agg(
        F.max("mes_referencia").alias("max_mes_referencia"), F.sum("PRIMA_UF").alias("PRIMA_DIRECTA")
    )


def report(rolled: DataFrame, total: DataFrame, period: ReportPeriod, reporter: Reporter, **skew) -> DataFrame:
    """The rollup with its instalment value, insured amount and vigency flag.

    ``hot`` may name keys with so many premiums that one task should not get them all.
    """
    keys = ["max_mes_referencia", "NNUMITEM", "NNUMDOCU"]
    premiums = total.select(
        F.col("MES_Recaudacion").cast("int").alias("max_mes_referencia"),
        F.col("foliocredito").cast("bigint").alias("NNUMITEM"),
        F.col("POLIZA").cast("bigint").alias("NNUMDOCU"),
        "ValorCuota",
    )
    joined = skew_left_join(rolled, premiums, keys, **skew)
    return joined.select(
        F.lit(reporter.company_number).alias("RUT_COMPANIA"),
        F.lit(reporter.company_digit).alias("DV_RUT_COMPANIA"),
        F.lit(reporter.company_name).alias("NOMBRE_COMPANIA"),
        "max_mes_referencia",
        *ITEM_KEYS[:6],
        "PRIMA_DIRECTA",
        *ITEM_KEYS[6:],
        F.lit(reporter.contractor_number).alias("RUT_CONTRATANTE"),
        F.lit(reporter.contractor_digit).alias("DV_CONTRANTE"),
        vigency(
            F.col("NNUMDOCU"), F.col("max_mes_referencia"),
            period.special_policies, period.special_vigency, period.vigency,
        ).alias("vigentes"),
        insured_amount(F.col("PLAN_TECNICO"), F.col("ValorCuota")).alias("MONTO_ASEGURADO_DIRECTO_CLP"),
        F.lit(SUBDIVISION).alias("Subdiv"),
        F.lit(REGULATOR_BRANCH).alias("RAMO_CMF"),
    )


def oficio(monitoring: DataFrame, total: DataFrame, period: ReportPeriod, reporter: Reporter, **skew) -> DataFrame:
    """Monitoring and consolidated premiums to the report."""
    return report(rollup(apply_cutoff(report_base(monitoring), period)), total, period, reporter, **skew)


def control_count(oficio_report: DataFrame) -> DataFrame:
    """Items in force and not in force."""
    return oficio_report.groupBy("vigentes").agg(F.count("NNUMDOCU").alias("REGISTROS"))
