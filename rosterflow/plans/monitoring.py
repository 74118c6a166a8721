"""Monitoring: the consolidated premiums by coverage, period and daily rate.

Detail rows (one per coverage of the policy) and total rows differ only in the
dimension they join and in a few constants, so both come from a single scan of
the consolidated table: every premium is taken once per wanted kind and meets
the dimension rows of that kind in one left join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.dates import next_day
from rosterflow.functions.numbers import in_units
from rosterflow.operators.relational import join_dimension
from rosterflow.session import compile_split_code

# The policies reported.
POLICIES = (4780715, 4780716, 4780717, 4780718, 4780719, 4659577, 4668266, 5698774, 6354562, 7561166)
# Attributes of an issued policy, in order; the total kind keeps those not in COVERAGE.
ATTRIBUTES = (
    "NNUMDOCU", "CCODLNRO", "LN", "CCODCOBE", "CCODRAMO", "NCORASVS", "PLAN_TECNICO", "RAMO_IBNR",
    "PARTNER_SUCURSAL", "BU", "COBERTURA1", "COBERTURA2", "TIPO_COBERTURA", "CONTRATO_REAS", "MCA_VIG",
    "CCOMOORI", "TIPO", "RUT_INT", "PARTNER_PYG", "PLAN_COMERCIAL_GOL", "CANAL_GOL", "SUCURSAL_GOL",
    "RUT_INTERMEDIARIO_GOL", "RUT_EJECUTIVO_GOL", "PARTNER_GOL", "BU_PYG", "ZONA_SUCURSAL",
    "RAMO_IBNR_ORIG", "COBERTURA_AGRUP",
)
COVERAGE = ("CCODCOBE", "COBERTURA1", "COBERTURA2", "COBERTURA_AGRUP")
# What a total row holds instead of its coverage.
TOTAL_CONSTANTS = {
    "CCODCOBE": "1", "NCORASVS": 99, "COBERTURA1": "TOTAL", "COBERTURA2": "TOTAL", "COBERTURA_AGRUP": "TOTAL",
}
# The monitoring table.
MONITORING_SCHEMA = {
    "NANOPROC": "decimal(4,0)", "NMESPROC": "decimal(2,0)", "CCODLNRO": "string", "LN": "decimal(9,0)",
    "NNUMDOCU": "decimal(20,0)", "NNUMENDO": "bigint", "NNUMITEM": "bigint", "NNUMCERT": "bigint",
    "PROPUESTA": "bigint", "CCODCOBE": "string", "CCODRAMO": "string", "NCORASVS": "decimal(5,0)",
    "PLAN_TECNICO": "decimal(5,0)", "RAMO_IBNR": "string", "PARTNER_SUCURSAL": "string", "BU": "string",
    "COBERTURA1": "string", "COBERTURA2": "string", "TIPO_COBERTURA": "string", "CONTRATO_REAS": "string",
    "MCA_VIG": "string", "TIPO": "string", "RUT_INT": "decimal(10,0)", "PARTNER_PYG": "string",
    "PLAN_COMERCIAL_GOL": "decimal(5,0)", "CANAL_GOL": "string", "SUCURSAL_GOL": "string",
    "RUT_INTERMEDIARIO_GOL": "decimal(10,0)", "RUT_EJECUTIVO_GOL": "decimal(10,0)", "PARTNER_GOL": "string",
    "BU_PYG": "string", "ZONA_SUCURSAL": "string", "RAMO_IBNR_ORIG": "string", "COBERTURA_AGRUP": "string",
    "NFECEMIS": "date", "NFEINVIG": "date", "NFETEVIG": "date", "CCOMOORI": "string", "TC": "int",
    "TC_UF": "double", "PRIMA": "double", "COMISION": "double", "PRIMA_CLP": "double",
    "COMISION_CLP": "double", "PRIMA_UF": "double", "COMISION_UF": "double",
}

DETAIL, TOTAL = "detail", "total"


def policy_dimension(
    emitted: DataFrame,
    kind: str = DETAIL,
    policies: Sequence[int] = POLICIES,
    *,
    dedupe_total: bool = False,
) -> DataFrame:
    """Distinct attributes of the reported policies with their row count ``casos``.

    The total kind leaves the coverage columns out but still groups by
    ``NCORASVS``, so a policy with several of them yields several total rows;
    ``dedupe_total`` groups without it.
    """
    names = [a for a in ATTRIBUTES if kind == DETAIL or a not in COVERAGE]
    grouped = [a for a in names if not (kind == TOTAL and dedupe_total and a == "NCORASVS")]
    return emitted.where(F.col("NNUMDOCU").isin(*policies)).groupBy(*grouped).agg(F.count("NNUMDOCU").alias("casos"))


def _both_kinds(emitted: DataFrame, kinds: Sequence[str], policies: Sequence[int], dedupe_total: bool) -> DataFrame:
    parts = []
    for kind in kinds:
        part = policy_dimension(emitted, kind, policies, dedupe_total=dedupe_total)
        types = {f.name: f.dataType for f in emitted.schema.fields}
        lost = {c: F.lit(None).cast(types[c]) for c in ATTRIBUTES if c not in part.columns}
        parts.append(part.withColumns({**lost, "_kind": F.lit(kind)}).select("_kind", *ATTRIBUTES))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def monitoring(
    total: DataFrame,
    emitted: DataFrame,
    period_map: DataFrame,
    fx_daily: DataFrame,
    *,
    kinds: Sequence[str] = (DETAIL, TOTAL),
    policies: Sequence[int] = POLICIES,
    partner: str | None = None,
    dedupe_total: bool = False,
) -> DataFrame:
    """Monitoring rows in the table's 46 columns.

    ``period_map`` has MES_REF, PER, PER_ANT; ``fx_daily`` has fecha, TC_UF.
    ``partner``, when given, overwrites both partner columns of every row.
    """
    compile_split_code(total.sparkSession)
    premiums = total.select(
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("_kind"),
        "MES_Recaudacion", "POLIZA", "foliocredito", "rutafiliado", "PrimaNeta", "Comision",
    )
    rates = fx_daily.select(F.col("fecha").cast("date").alias("_day"), F.col("TC_UF"))
    periods = period_map.select("MES_REF", F.col("PER").cast("date").alias("PER"), F.col("PER_ANT").cast("date").alias("PER_ANT"))
    # One row per month and one per day: resolved once, before the premiums are touched.
    calendar = periods.join(rates, F.col("PER") == F.col("_day"), "left")
    # A premium has many coverages: what does not depend on them is computed before they are joined.
    rows = join_dimension(premiums, _with_early(calendar, _of_month()), F.col("MES_Recaudacion") == F.col("MES_REF"))
    rows = rows.select("_kind", "POLIZA", *[c.cast(MONITORING_SCHEMA[n]).alias(n) for n, c in _of_premium().items()])
    a = _both_kinds(emitted, kinds, policies, dedupe_total)
    dimension = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns])
    own = {n: F.col(f"a_{n}") for n in ATTRIBUTES if dict(a.dtypes)[n] != MONITORING_SCHEMA[n]}
    rows = join_dimension(
        rows, _with_early(dimension, own), (F.col("POLIZA") == F.col("a_NNUMDOCU")) & (F.col("_kind") == F.col("a__kind"))
    )
    return _monitoring_columns(rows, own, partner)


def _with_early(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``columns`` in the table's types where they fit: converted once per row of a dimension."""
    return df.withColumns({f"_early_{n}": c.try_cast(MONITORING_SCHEMA[n]) for n, c in columns.items()})


def _typed(name: str, c: Column) -> Column:
    """The early value; what has none is converted per row, where a value that does not fit stops the job."""
    return F.coalesce(F.col(f"_early_{name}"), c.cast(MONITORING_SCHEMA[name]))


def _of_month() -> dict[str, Column]:
    return {"NANOPROC": F.year("PER_ANT"), "NMESPROC": F.month("PER_ANT")}


def _of_premium() -> dict[str, Column]:
    negative = F.col("Comision") * -1
    folio = F.col("foliocredito").cast("bigint")
    return {
        **{n: _typed(n, c) for n, c in _of_month().items()},
        "NNUMDOCU": F.col("POLIZA"),
        "NNUMENDO": F.lit(0),
        "NNUMITEM": folio,
        "NNUMCERT": F.col("rutafiliado"),
        "PROPUESTA": folio,
        "NFECEMIS": F.col("PER"),
        "NFEINVIG": F.col("PER_ANT"),
        "NFETEVIG": next_day(F.col("PER")),
        "CCOMOORI": F.lit("CLP"),
        "TC": F.lit(0),
        "TC_UF": F.col("TC_UF"),
        "PRIMA": F.col("PrimaNeta"),
        # Kept as reported: the total rows carry the commission with its own sign here.
        "COMISION": F.when(F.col("_kind") == TOTAL, F.col("Comision")).otherwise(negative),
        "PRIMA_CLP": F.col("PrimaNeta"),
        "COMISION_CLP": negative,
        "PRIMA_UF": in_units(F.col("PrimaNeta"), F.col("TC_UF")),
        "COMISION_UF": in_units(negative, F.col("TC_UF")),
    }


def _monitoring_columns(rows: DataFrame, early: Mapping[str, Column], partner: str | None) -> DataFrame:
    is_total = F.col("_kind") == TOTAL

    def attribute(name: str) -> Column:
        if partner is not None and name in ("PARTNER_SUCURSAL", "PARTNER_GOL"):
            return F.lit(partner)
        own = _typed(name, early[name]) if name in early else F.col(f"a_{name}")
        if name in TOTAL_CONSTANTS:
            return F.when(is_total, F.lit(TOTAL_CONSTANTS[name]).cast(MONITORING_SCHEMA[name])).otherwise(own)
        return own

    told = _of_premium()
    return rows.select(*[(F.col(n) if n in told else attribute(n)).cast(t).alias(n) for n, t in MONITORING_SCHEMA.items()])
