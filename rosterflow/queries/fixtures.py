"""The given tables seen as broker histories, policies, periods and rates.

Each view exists twice: as a DataFrame and as the SQL text used by the oracle.
Dates are moved ten years ahead, since a period starts with 20.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans.monitoring import ATTRIBUTES, COVERAGE, MONITORING_SCHEMA
from rosterflow.plans.oficio import Reporter, ReportPeriod
from rosterflow.queries.registry import table

# One broker per return flag and line status; together they are the whole table.
BROKER_ROWS = {
    "marsh": ("A", "F"), "conosur": ("A", "O"), "flujo2": ("N", "F"),
    "flujo": ("N", "O"), "stock": ("R", "F"), "planes": ("R", "O"),
}
PERIOD = ReportPeriod("201112", 200612, 200611, 201110, 201109, (6354562, 7561166))
REPORTER = Reporter(10000000, 8, "Compania de prueba", 20000000, 5)

_SHIFTED = "(year({d}) + 10) * 100 + month({d})"


def shifted_period(column: str):
    return (F.year(column) + 10) * 100 + F.month(column)


def day_number(column: str):
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("bigint")


def histories(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Six histories with the column names of their brokers."""
    items = table(spark, sf_dir, "lineitem")
    common = items.select(
        "l_returnflag", "l_linestatus",
        F.col("l_orderkey").alias("foliocredito"), F.col("l_suppkey").alias("rutafiliado"),
        F.col("l_extendedprice").alias("MontoBruto"), F.col("l_linenumber").alias("Plazo"),
        day_number("l_shipdate").alias("fechaPrimerVto"), day_number("l_shipdate").alias("FechaUltimoVto"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("ValorCuota"),
        day_number("l_shipdate").alias("FechaPrima"),
        F.concat("l_returnflag", "l_linestatus").alias("Producto"),
        F.col("l_partkey").alias("FolioOrigen"), day_number("l_shipdate").alias("FechaOrigen"),
        F.col("l_extendedprice").alias("PrimaBruta"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("PrimaNeta"),
        F.concat(F.lit("Facturacion_Cesantia_"), shifted_period("l_shipdate"), F.lit(".xlsx")).alias("Nombre_de_archivo"),
        F.expr(
            "case l_linenumber when 1 then 'Plan 12 Cuotas' when 2 then 'Plan 8 Cuotas' when 3 then 'Plan 03 Cuotas' "
            "when 4 then 'Plan 4 Cuotas' when 6 then 'Plan 06 Cuotas' else 'Plan 5 Cuotas' end"
        ).alias("Planes"),
    )
    result = {}
    for name, (flag, status) in BROKER_ROWS.items():
        own = common.where((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status))
        own = own.drop("l_returnflag", "l_linestatus")
        if name == "marsh":
            own = own.withColumnsRenamed({"PrimaBruta": "Prima_Bruta_mensual", "PrimaNeta": "Prima_Neta"})
            own = own.withColumn("Poliza", F.lit(7561166)).drop("Planes")
        elif name == "conosur":
            own = own.withColumnsRenamed({"PrimaBruta": "PrimaBrutaMensual", "PrimaNeta": "PrimaNetaMensual"})
            own = own.withColumn("POLIZA", F.lit(6354562)).drop("Planes")
        else:
            own = own.drop("FechaPrima") if name == "planes" else own.drop("FechaPrima", "Planes")
        result[name] = own
    return result


TOTAL_SQL = f"""
total_base AS (
  SELECT *, {_SHIFTED.format(d='l_shipdate')} AS file_period,
    year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS d
  FROM lineitem),
total_tagged AS (
  SELECT
    CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN
      CASE WHEN file_period % 100 = 1 THEN file_period - 89 ELSE file_period - 1 END
      ELSE file_period END AS INTEGER) AS MES_Recaudacion,
    CAST(CASE l_returnflag || l_linestatus
      WHEN 'AF' THEN 7561166 WHEN 'AO' THEN 6354562 WHEN 'NF' THEN 5698774
      WHEN 'NO' THEN 4659577 WHEN 'RF' THEN 4668266
      ELSE CASE l_linenumber WHEN 1 THEN 4780719 WHEN 2 THEN 4780718 WHEN 3 THEN 4780715
        WHEN 4 THEN 4780716 WHEN 6 THEN 4780717 END END AS BIGINT) AS POLIZA,
    l_orderkey AS foliocredito, l_suppkey AS rutafiliado, l_extendedprice AS MontoBruto,
    CAST(l_linenumber AS BIGINT) AS Plazo, CAST(d AS BIGINT) AS fechaPrimerVto, CAST(d AS BIGINT) AS FechaUltimoVto,
    l_extendedprice / l_quantity AS ValorCuota,
    CASE WHEN l_returnflag = 'A' THEN CAST(d AS BIGINT) END AS FechaPrima,
    l_returnflag || l_linestatus AS Producto, l_partkey AS FolioOrigen, CAST(d AS BIGINT) AS FechaOrigen,
    CAST(CASE l_returnflag || l_linestatus
      WHEN 'AF' THEN 8285 WHEN 'AO' THEN 6832 WHEN 'NF' THEN 6270 WHEN 'NO' THEN 4277 WHEN 'RF' THEN 4277
      ELSE CASE l_linenumber WHEN 1 THEN 4334 WHEN 2 THEN 4333 WHEN 3 THEN 4331
        WHEN 4 THEN 4422 WHEN 6 THEN 4332 END END AS INTEGER) AS PLAN_TECNICO,
    CAST(CASE WHEN l_returnflag || l_linestatus <> 'RO' THEN 4
      ELSE CASE l_linenumber WHEN 1 THEN 12 WHEN 2 THEN 8 WHEN 3 THEN 3
        WHEN 4 THEN 4 WHEN 6 THEN 6 END END AS INTEGER) AS PLAZO_CUOTAS,
    'Credito Consumo' AS Negocio, l_extendedprice AS PrimaBruta,
    l_extendedprice * (1 - l_discount) AS PrimaNeta
  FROM total_base),
total AS (
  SELECT *, CASE WHEN PLAN_TECNICO = 4277 THEN 0.0476::DOUBLE * PrimaNeta
    WHEN PLAN_TECNICO IN (4331, 4332, 4333, 4334, 4422) THEN 0.0874::DOUBLE * PrimaNeta
    WHEN PLAN_TECNICO = 6270 THEN 0.0665::DOUBLE * PrimaNeta
    WHEN PLAN_TECNICO IN (6832, 8285) THEN 0.0087::DOUBLE * PrimaNeta
    ELSE 0.0 END AS Comision
  FROM total_tagged)"""


# Policies by size class of a part, the last one not reported.
ISSUED = (4780715, 4780716, 4780717, 4780718, 4780719, 4659577, 4668266, 5698774, 7561166, 999)
REPORTED = ISSUED[:-1]
# What a policy has besides its coverage, by its class j: every attribute another value, some without one.
POLICY_ATTRIBUTES = {
    name: f"CASE WHEN j % {3 + i % 5} = {i % 3} THEN NULL ELSE "
    + (f"j * {i + 3} + {10 * i}" if MONITORING_SCHEMA.get(name, "").startswith("decimal") else f"'{name[:4].lower()}{i} ' || CAST(j AS STRING)") + " END"
    for i, name in enumerate(ATTRIBUTES) if name not in (*COVERAGE, "NNUMDOCU", "NCORASVS", "PLAN_TECNICO")
}


def emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issued policies: one row per part, its size class choosing the policy."""
    numbers = F.array(*[F.lit(p) for p in ISSUED])
    j = F.floor((F.col("p_size") - 1) / 5).cast("int")
    own = {
        "NNUMDOCU": F.get(numbers, F.col("j")), "CCODCOBE": F.substring("p_type", 1, 5),
        "NCORASVS": F.when(F.col("p_retailprice") > 1000, 31).otherwise(32), "PLAN_TECNICO": F.col("j") + 4330,
        "COBERTURA1": F.col("p_type"), "COBERTURA2": F.lower("p_type"),
        "COBERTURA_AGRUP": F.expr("case p_type when 'PROMO' then 'TOTAL' when 'SMALL' then null else p_type end"),
        **{name: F.expr(value) for name, value in POLICY_ATTRIBUTES.items()},
    }
    return table(spark, sf_dir, "part").withColumn("j", j).select(*[own[a].alias(a) for a in ATTRIBUTES])


EMITTED_SQL = """
emitted AS (
  SELECT [4780715, 4780716, 4780717, 4780718, 4780719, 4659577, 4668266, 5698774, 7561166, 999][((p_size - 1) // 5) + 1] AS NNUMDOCU,
    substr(p_type, 1, 5) AS CCODCOBE, CASE WHEN p_retailprice > 1000 THEN 31 ELSE 32 END AS NCORASVS,
    (p_size - 1) // 5 + 4330 AS PLAN_TECNICO, p_type AS COBERTURA1, lower(p_type) AS COBERTURA2,
    CASE p_type WHEN 'PROMO' THEN 'TOTAL' WHEN 'SMALL' THEN NULL ELSE p_type END AS COBERTURA_AGRUP
  FROM part),
dim_detail AS (
  SELECT NNUMDOCU, CCODCOBE, NCORASVS, PLAN_TECNICO, COBERTURA1, COBERTURA2, COBERTURA_AGRUP, count(NNUMDOCU) AS casos
  FROM emitted
  WHERE NNUMDOCU IN (4780715, 4780716, 4780717, 4780718, 4780719, 4659577, 4668266, 5698774, 6354562, 7561166)
  GROUP BY ALL),
dim_total AS (
  SELECT NNUMDOCU, NCORASVS, PLAN_TECNICO, count(NNUMDOCU) AS casos
  FROM emitted
  WHERE NNUMDOCU IN (4780715, 4780716, 4780717, 4780718, 4780719, 4659577, 4668266, 5698774, 6354562, 7561166)
  GROUP BY ALL)"""


def period_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that have orders; the last shipping months have none."""
    months = table(spark, sf_dir, "orders").select(shifted_period("o_orderdate").alias("MES_REF")).distinct()
    first = F.make_date(F.floor(F.col("MES_REF") / 100).cast("int"), F.col("MES_REF") % 100, F.lit(1))
    return months.select("MES_REF", first.alias("PER"), F.add_months(first, -1).alias("PER_ANT"))


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate per day that has orders; low days have a rate of zero."""
    rate = F.min("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.add_months("o_orderdate", 120).alias("fecha"))
        .agg(F.when(rate < 5000, 0.0).otherwise(rate).alias("TC_UF"))
    )


CALENDAR_SQL = f"""
period_map AS (
  SELECT DISTINCT {_SHIFTED.format(d='o_orderdate')} AS MES_REF,
    make_date(year(o_orderdate) + 10, month(o_orderdate), 1) AS PER,
    CAST(make_date(year(o_orderdate) + 10, month(o_orderdate), 1) - INTERVAL 1 MONTH AS DATE) AS PER_ANT
  FROM orders),
fx_daily AS (
  SELECT CAST(o_orderdate + INTERVAL 120 MONTH AS DATE) AS fecha,
    CASE WHEN min(o_totalprice) < 5000 THEN 0.0 ELSE min(o_totalprice) END AS TC_UF
  FROM orders GROUP BY 1)"""

# Every premium once per kind; a total row has its constants whether or not its policy is known.
MONITORING_SQL = f"""{TOTAL_SQL},{EMITTED_SQL},{CALENDAR_SQL},
months AS (SELECT MES_REF, PER, PER_ANT, TC_UF FROM period_map LEFT JOIN fx_daily ON fecha = PER),
issued AS (
  SELECT 'detail' AS kind, * EXCLUDE (casos) FROM dim_detail
  UNION ALL BY NAME SELECT 'total' AS kind, NNUMDOCU, NCORASVS, PLAN_TECNICO FROM dim_total),
premiums AS (
  SELECT kind, MES_Recaudacion, POLIZA, foliocredito, rutafiliado, PrimaNeta, -Comision AS paid,
    CASE kind WHEN 'total' THEN Comision ELSE -Comision END AS told
  FROM (VALUES ('detail'), ('total')) kinds(kind), total),
monitoring AS (
  SELECT premiums.kind, year(PER_ANT) AS NANOPROC, month(PER_ANT) AS NMESPROC, POLIZA AS NNUMDOCU, foliocredito AS NNUMITEM,
    rutafiliado AS NNUMCERT, PLAN_TECNICO, PER AS NFECEMIS, PER_ANT AS NFEINVIG, CAST(PER + INTERVAL 1 DAY AS DATE) AS NFETEVIG,
    CASE premiums.kind WHEN 'total' THEN '1' ELSE CCODCOBE END AS CCODCOBE,
    CASE premiums.kind WHEN 'total' THEN 99 ELSE NCORASVS END AS NCORASVS,
    CASE premiums.kind WHEN 'total' THEN 'TOTAL' ELSE COBERTURA1 END AS COBERTURA1,
    CASE premiums.kind WHEN 'total' THEN 'TOTAL' ELSE COBERTURA2 END AS COBERTURA2,
    CASE premiums.kind WHEN 'total' THEN 'TOTAL' ELSE COBERTURA_AGRUP END AS COBERTURA_AGRUP,
    TC_UF, PrimaNeta AS PRIMA, PrimaNeta AS PRIMA_CLP, PrimaNeta / nullif(TC_UF, 0) AS PRIMA_UF,
    told AS COMISION, paid AS COMISION_CLP, paid / nullif(TC_UF, 0) AS COMISION_UF
  FROM premiums
  LEFT JOIN issued ON issued.kind = premiums.kind AND issued.NNUMDOCU = POLIZA
  LEFT JOIN months ON MES_REF = MES_Recaudacion)"""

OFICIO_SQL = MONITORING_SQL + f""",
base AS (
  SELECT NANOPROC * 100 + NMESPROC AS mes_referencia, NNUMCERT AS RUT, NNUMDOCU, NNUMITEM, PLAN_TECNICO,
    NCORASVS AS COD_RAMO, PRIMA_UF
  FROM monitoring WHERE COBERTURA_AGRUP <> 'TOTAL'),
kept AS (
  SELECT * FROM base WHERE NOT coalesce(
    (NNUMDOCU IN (6354562, 7561166) AND mes_referencia < {PERIOD.special_cutoff})
    OR (NNUMDOCU NOT IN (6354562, 7561166) AND mes_referencia < {PERIOD.cutoff}), false)),
rolled AS (
  SELECT max(mes_referencia) AS max_mes_referencia, RUT, NNUMDOCU, NNUMITEM, PLAN_TECNICO, COD_RAMO,
    sum(PRIMA_UF) AS PRIMA_DIRECTA
  FROM kept GROUP BY RUT, NNUMDOCU, NNUMITEM, PLAN_TECNICO, COD_RAMO),
instalments AS (SELECT MES_Recaudacion AS max_mes_referencia, foliocredito AS NNUMITEM, POLIZA AS NNUMDOCU, ValorCuota FROM total),
report AS (
  SELECT rolled.*, ValorCuota * coalesce((MAP {{4331: 3, 4332: 6, 4333: 8, 4334: 12}})[PLAN_TECNICO::INTEGER], 4) AS MONTO_ASEGURADO_DIRECTO_CLP,
    coalesce(CAST(max_mes_referencia = CASE WHEN NNUMDOCU IN (6354562, 7561166) THEN {PERIOD.special_vigency}
      WHEN NNUMDOCU IS NOT NULL THEN {PERIOD.vigency} END AS INTEGER), 0) AS vigentes
  FROM rolled LEFT JOIN instalments USING (max_mes_referencia, NNUMITEM, NNUMDOCU))"""
