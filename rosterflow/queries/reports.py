"""Consolidation, monitoring and the regulator report over the whole line item table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans import monitoring as mon
from rosterflow.plans import oficio as rep
from rosterflow.plans.consolidation import BROKERS, FILE_KEY, TOTAL_COLUMNS, consolidate, consolidated, final_table
from rosterflow.queries import fixtures as fx
from rosterflow.queries.registry import cents, cents_sql, query
from rosterflow.session import fresh_path, settle
from rosterflow.sinks.versioned import History


def total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(fx.histories(spark, sf_dir))


def monitoring(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return mon.monitoring(
        total(spark, sf_dir), fx.emitted(spark, sf_dir), fx.period_map(spark, sf_dir), fx.fx_daily(spark, sf_dir), **options
    )


@query(f"""WITH {fx.TOTAL_SQL}
SELECT {', '.join(TOTAL_COLUMNS)}, 0.0::DOUBLE AS Comision FROM total_tagged""")
def consolidate_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    finals = {n: final_table(df, BROKERS[n]) for n, df in fx.histories(spark, sf_dir).items()}
    return consolidated(finals)


@query(f"""WITH {fx.TOTAL_SQL}
SELECT MES_Recaudacion, PLAN_TECNICO, count(*) AS filas, {cents_sql('sum(PrimaNeta)', 2)} AS prima_neta,
  {cents_sql('sum(Comision)', 2)} AS comision
FROM total GROUP BY MES_Recaudacion, PLAN_TECNICO""")
def commission_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total(spark, sf_dir).groupBy("MES_Recaudacion", "PLAN_TECNICO").agg(
        F.count("*").alias("filas"), cents(F.sum("PrimaNeta"), 2).alias("prima_neta"),
        cents(F.sum("Comision"), 2).alias("comision"),
    )


@query(f"""WITH {fx.TOTAL_SQL}
SELECT POLIZA, PLAN_TECNICO, PLAZO_CUOTAS, Negocio, MES_Recaudacion, count(*) AS filas
FROM total_tagged WHERE Producto = 'RO' GROUP BY ALL""")
def plan_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = final_table(fx.histories(spark, sf_dir)["planes"], BROKERS["planes"])
    return planes.groupBy("POLIZA", "PLAN_TECNICO", "PLAZO_CUOTAS", "Negocio", "MES_Recaudacion").agg(
        F.count("*").alias("filas")
    ).withColumn("POLIZA", F.col("POLIZA").cast("bigint"))


@query(f"""WITH {fx.EMITTED_SQL}
SELECT 'detail' AS kind, NNUMDOCU, CCODCOBE, NCORASVS, PLAN_TECNICO, COBERTURA1, COBERTURA_AGRUP, casos FROM dim_detail
UNION ALL SELECT 'total', NNUMDOCU, NULL, NCORASVS, PLAN_TECNICO, NULL, NULL, casos FROM dim_total""")
def policy_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued = fx.emitted(spark, sf_dir)
    shown = ["NNUMDOCU", "CCODCOBE", "NCORASVS", "PLAN_TECNICO", "COBERTURA1", "COBERTURA_AGRUP", "casos"]
    detail = mon.policy_dimension(issued, mon.DETAIL).select(F.lit("detail").alias("kind"), *shown)
    totals = mon.policy_dimension(issued, mon.TOTAL).withColumn("kind", F.lit("total"))
    return detail.unionByName(totals.select("kind", "NNUMDOCU", "NCORASVS", "PLAN_TECNICO", "casos"), allowMissingColumns=True)


_MONITORING_SHOWN = f"""SELECT NANOPROC, NMESPROC, NNUMDOCU, CCODCOBE, NCORASVS, PLAN_TECNICO, COBERTURA1, COBERTURA_AGRUP,
  NFECEMIS, NFEINVIG, NFETEVIG, TC_UF, count(*) AS filas, count(DISTINCT NNUMITEM) AS items, sum(NNUMCERT)::BIGINT AS certs,
  {cents_sql('sum(PRIMA)', 2)} AS prima, {cents_sql('sum(COMISION)', 2)} AS comision, {cents_sql('sum(PRIMA_UF)', 4)} AS prima_uf,
  {cents_sql('sum(COMISION_UF)', 4)} AS comision_uf
FROM monitoring WHERE kind = '{{kind}}' GROUP BY ALL"""


def _monitoring_shown(df: DataFrame) -> DataFrame:
    keys = ["NANOPROC", "NMESPROC", "NNUMDOCU", "CCODCOBE", "NCORASVS", "PLAN_TECNICO", "COBERTURA1", "COBERTURA_AGRUP",
            "NFECEMIS", "NFEINVIG", "NFETEVIG", "TC_UF"]
    grouped = df.groupBy(*keys).agg(
        F.count("*").alias("filas"), F.countDistinct("NNUMITEM").alias("items"), F.sum("NNUMCERT").alias("certs"),
        cents(F.sum("PRIMA"), 2).alias("prima"), cents(F.sum("COMISION"), 2).alias("comision"),
        cents(F.sum("PRIMA_UF"), 4).alias("prima_uf"), cents(F.sum("COMISION_UF"), 4).alias("comision_uf"),
    )
    whole = {n: F.col(n).cast("bigint") for n in ("NANOPROC", "NMESPROC", "NNUMDOCU", "NCORASVS", "PLAN_TECNICO")}
    return grouped.withColumns(whole)


@query(f"WITH {fx.MONITORING_SQL}\n" + _MONITORING_SHOWN.format(kind="detail"))
def monitoring_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monitoring_shown(monitoring(spark, sf_dir, kinds=(mon.DETAIL,)))


@query(f"WITH {fx.MONITORING_SQL}\n" + _MONITORING_SHOWN.format(kind="total"))
def monitoring_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monitoring_shown(monitoring(spark, sf_dir, kinds=(mon.TOTAL,)))


# Constant columns and those that stand twice, with the columns of the policy's class.
_WHOLE_ROW = {
    "NNUMENDO": "0", "PROPUESTA": "NNUMITEM", "CCOMOORI": "'CLP'", "TC": "0",
    **{name: f"CASE WHEN NNUMDOCU IN {fx.REPORTED} THEN {value} END" for name, value in fx.POLICY_ATTRIBUTES.items() if name != "CCOMOORI"},
}


def _cell(name: str, kind: str) -> str:
    """A column's value as text, the same in both engines; amounts by ten thousandths."""
    value = _WHOLE_ROW.get(name, name)
    if kind == "double":
        value = f"CAST(floor({value} * 10000.0::DOUBLE) AS BIGINT)"
    elif kind == "date":
        value = f"strftime({value}, '%Y-%m-%d')"
    elif kind != "string":
        value = f"CAST({value} AS BIGINT)"
    return f"coalesce(CAST({value} AS STRING), '~')"


@query(f"""WITH {fx.MONITORING_SQL},
classed AS (SELECT *, list_position({list(fx.ISSUED)}, NNUMDOCU) - 1 AS j FROM monitoring),
texts AS (SELECT kind, NANOPROC, NMESPROC, md5(concat_ws('|', {', '.join(_cell(n, k) for n, k in mon.MONITORING_SCHEMA.items())})) AS d FROM classed)
SELECT kind, NANOPROC, NMESPROC, count(*) AS filas, sum(('0x' || substr(d, 1, 8))::BIGINT)::BIGINT AS huella FROM texts GROUP BY ALL""")
def monitoring_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of both kinds with all 46 columns, summed up by the digest of the row: a value in another column, or another value, shows."""
    found = []
    for kind in (mon.DETAIL, mon.TOTAL):
        rows = monitoring(spark, sf_dir, kinds=(kind,))
        cells = []
        for name, type_ in mon.MONITORING_SCHEMA.items():
            c = F.col(name)
            if type_ == "double":
                c = F.floor(c * 10000.0)
            elif type_ == "date":
                c = c.cast("string")
            elif type_ != "string":
                c = c.cast("bigint")
            cells.append(F.coalesce(c.cast("string"), F.lit("~")))
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")
        found.append(rows.select(F.lit(kind).alias("kind"), F.col("NANOPROC").cast("bigint").alias("NANOPROC"), F.col("NMESPROC").cast("bigint").alias("NMESPROC"), digest.alias("d")))
    return found[0].unionByName(found[1]).groupBy("kind", "NANOPROC", "NMESPROC").agg(F.count("*").alias("filas"), F.sum("d").alias("huella"))


@query(f"""WITH {fx.MONITORING_SQL}
SELECT 'Socio' AS PARTNER_SUCURSAL, 'Socio' AS PARTNER_GOL, 'CLP' AS CCOMOORI, COBERTURA_AGRUP, count(*) AS filas,
  {cents_sql('sum(COMISION)', 2)} AS comision, {cents_sql('sum(COMISION_CLP)', 2)} AS comision_clp
FROM monitoring GROUP BY COBERTURA_AGRUP""")
def monitoring_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds from one scan, with the partner overwritten."""
    return monitoring(spark, sf_dir, partner="Socio").groupBy(
        "PARTNER_SUCURSAL", "PARTNER_GOL", "CCOMOORI", "COBERTURA_AGRUP"
    ).agg(
        F.count("*").alias("filas"), cents(F.sum("COMISION"), 2).alias("comision"),
        cents(F.sum("COMISION_CLP"), 2).alias("comision_clp"),
    )


_CUTOFF_SQL = f"""WITH {fx.OFICIO_SQL}
SELECT NNUMDOCU, mes_referencia, count(*) AS filas, {cents_sql('sum(PRIMA_UF)', 4)} AS prima_uf FROM kept
GROUP BY NNUMDOCU, mes_referencia"""


def _kept(detail: DataFrame) -> DataFrame:
    return rep.apply_cutoff(rep.report_base(detail), fx.PERIOD).groupBy("NNUMDOCU", "mes_referencia").agg(
        F.count("*").alias("filas"), cents(F.sum("PRIMA_UF"), 4).alias("prima_uf")
    )


@query(_CUTOFF_SQL)
def cutoff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(monitoring(spark, sf_dir, kinds=(mon.DETAIL,)))


@query(_CUTOFF_SQL)
def cutoff_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from versioned histories, of which only the folders of reported months are read."""
    stores = {}
    for name, rows in fx.histories(spark, sf_dir).items():
        stores[name] = History(spark, fresh_path(spark, f"broker-{name}"), FILE_KEY)
        stores[name].replace(rows)
    months = fx.period_map(spark, sf_dir)
    read = rep.reported_histories(stores, months, fx.PERIOD)
    detail = mon.monitoring(consolidate(read), fx.emitted(spark, sf_dir), months, fx.fx_daily(spark, sf_dir), kinds=(mon.DETAIL,))
    return _kept(detail)


@query(f"""WITH {fx.OFICIO_SQL}
SELECT CAST(max_mes_referencia AS INTEGER) AS max_mes_referencia, 1 AS COD_TIPO_DOCUMENTO_ASEGURADO, RUT, NNUMDOCU, NNUMITEM,
  PLAN_TECNICO, COD_RAMO, 3 AS COD_PERIODICIDAD_PAGO, 9 AS COD_TIPO_PAGO, {cents_sql('PRIMA_DIRECTA', 4)} AS PRIMA_DIRECTA
FROM rolled""")
def oficio_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rep.apply_cutoff(rep.report_base(monitoring(spark, sf_dir, kinds=(mon.DETAIL,))), fx.PERIOD)
    return rep.rollup(kept).withColumn("PRIMA_DIRECTA", cents(F.col("PRIMA_DIRECTA"), 4))


def _oficio(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The consolidated table is read twice, by monitoring and by the report: write it once.
    premiums = settle(total(spark, sf_dir), "total")
    detail = mon.monitoring(
        premiums, fx.emitted(spark, sf_dir), fx.period_map(spark, sf_dir), fx.fx_daily(spark, sf_dir), kinds=(mon.DETAIL,)
    )
    return rep.oficio(detail, premiums, fx.PERIOD, fx.REPORTER)


@query(f"""WITH {fx.OFICIO_SQL}
SELECT {fx.REPORTER.company_number} AS RUT_COMPANIA, {fx.REPORTER.company_digit} AS DV_RUT_COMPANIA,
  '{fx.REPORTER.company_name}' AS NOMBRE_COMPANIA, CAST(max_mes_referencia AS INTEGER) AS max_mes_referencia,
  1 AS COD_TIPO_DOCUMENTO_ASEGURADO, RUT, NNUMDOCU, NNUMITEM, PLAN_TECNICO, COD_RAMO,
  {cents_sql('PRIMA_DIRECTA', 4)} AS PRIMA_DIRECTA, 3 AS COD_PERIODICIDAD_PAGO, 9 AS COD_TIPO_PAGO,
  {fx.REPORTER.contractor_number} AS RUT_CONTRATANTE, {fx.REPORTER.contractor_digit} AS DV_CONTRANTE, vigentes,
  {cents_sql('MONTO_ASEGURADO_DIRECTO_CLP', 2)} AS MONTO_ASEGURADO_DIRECTO_CLP, '3B' AS Subdiv, 33 AS RAMO_CMF
FROM report""")
def oficio_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _oficio(spark, sf_dir).withColumns({
        "PRIMA_DIRECTA": cents(F.col("PRIMA_DIRECTA"), 4),
        "MONTO_ASEGURADO_DIRECTO_CLP": cents(F.col("MONTO_ASEGURADO_DIRECTO_CLP"), 2),
    })


@query(f"""WITH {fx.OFICIO_SQL}
SELECT vigentes, count(NNUMDOCU) AS REGISTROS FROM report GROUP BY vigentes""")
def oficio_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.control_count(_oficio(spark, sf_dir))
