"""Consolidation, monitoring and report on small fixtures: what is pinned on purpose."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterflow.plans import monitoring as mon
from rosterflow.plans import oficio as rep
from rosterflow.plans.consolidation import BROKERS, consolidate, final_table
from rosterflow.plans.roster import load_into_history, load_roster, load_with_audit
from rosterflow.queries import fixtures as fx
from rosterflow.sinks.versioned import History
from rosterflow.sources.contracts import CONTRACTS


@pytest.fixture(scope="module")
def premiums(spark):
    rows = [(202503, 4659577, 10, 77, 1000.0, 100.0), (202503, 4659577, 11, 78, 1000.0, -50.0),
            (202504, 6354562, 12, 79, 300.0, 30.0), (202505, 1, 13, 80, 200.0, 20.0), (None, None, 14, 81, 1.0, 0.1)]
    return spark.createDataFrame(rows, "MES_Recaudacion int, POLIZA bigint, foliocredito bigint, rutafiliado bigint, PrimaNeta double, Comision double").withColumn("ValorCuota", F.lit(5.0))


@pytest.fixture(scope="module")
def dimensions(spark):
    own = [(4659577, "A", 31, "Cesantia"), (4659577, "A", 31, "Cesantia"), (4659577, "B", 32, "TOTAL"), (4659577, "C", 32, None), (999, "A", 31, "X")]
    emitted = spark.createDataFrame(own, "NNUMDOCU bigint, CCODCOBE string, NCORASVS int, COBERTURA_AGRUP string")
    emitted = emitted.select(*[a if a in emitted.columns else F.lit(None).cast("string").alias(a) for a in mon.ATTRIBUTES])
    periods = spark.createDataFrame([(202503, date(2025, 3, 31), date(2025, 2, 28)), (202504, date(2025, 4, 30), date(2025, 3, 31))], "MES_REF int, PER date, PER_ANT date")
    rates = spark.createDataFrame([("2025-03-31", 40.0), ("2025-04-30", 0.0)], "fecha string, TC_UF double")
    return emitted, periods, rates


def test_monitoring_pins(premiums, dimensions):
    df = mon.monitoring(premiums, *dimensions, partner="Socio")
    assert df.columns == list(mon.MONITORING_SCHEMA)
    detail, total = df.where("COBERTURA1 is null"), df.where("COBERTURA1 = 'TOTAL'")
    # Two premiums meet three coverages each; the other three premiums meet none.
    assert detail.count() == 9
    # Grouping by a branch that is not shown doubles the totals of that policy.
    assert total.count() == 2 * 2 + 3
    row = detail.where("NNUMITEM = 10 and CCODCOBE = 'A'").first()
    assert (row["NANOPROC"], row["NMESPROC"], row["NFETEVIG"]) == (2025, 2, date(2025, 4, 1))
    assert (row["COMISION"], row["COMISION_CLP"], row["PRIMA_UF"]) == (-100.0, -100.0, 25.0)
    row = total.where("NNUMITEM = 10").first()
    assert (row["COMISION"], row["COMISION_CLP"], row["NCORASVS"], row["CCODCOBE"]) == (100.0, -100.0, 99, "1")
    assert {r[0] for r in df.select("PARTNER_GOL").distinct().collect()} == {"Socio"}
    # A missing period, or a rate of zero, leaves the unit amounts null and keeps the row.
    assert df.where("NNUMITEM in (12, 13) and PRIMA_UF is null").count() == 4


def test_total_can_be_deduplicated(premiums, dimensions):
    df = mon.monitoring(premiums, *dimensions, kinds=(mon.TOTAL,), dedupe_total=True)
    assert df.where("NNUMITEM = 10").count() == 1


def test_report(spark, premiums, dimensions):
    detail = mon.monitoring(premiums, *dimensions, kinds=(mon.DETAIL,))
    period = rep.ReportPeriod("202505", 202501, 202501, 202502, 202503, (6354562,))
    report = rep.oficio(detail, premiums, period, fx.REPORTER)
    # Only rows with a coverage group other than TOTAL remain.
    assert {(r["NNUMITEM"], r["vigentes"]) for r in report.collect()} == {(10, 1), (11, 1)}
    assert {(r["vigentes"], r["REGISTROS"]) for r in rep.control_count(report).collect()} == {(1, 2)}


def test_cutoff_keeps_rows_without_policy(spark):
    base = spark.createDataFrame([(1, 202401), (2, 202401), (None, 202401), (2, None), (2, 202501)], "NNUMDOCU bigint, mes_referencia int")
    period = rep.ReportPeriod("x", 202412, 202311, 0, 0, (1,))
    assert rep.apply_cutoff(base, period).count() == 4


def test_late_broker_and_plan_text(spark):
    df = spark.createDataFrame([("F_202501.xlsx", "Plan 3 Cuotas"), ("F_202512.xlsx", "otro"), ("F_235959.xlsx", None)], "Nombre_de_archivo string, Planes string")
    assert [r[0] for r in final_table(df, BROKERS["marsh"]).select("MES_Recaudacion").collect()] == [202412, 202511, None]
    got = final_table(df, BROKERS["planes"]).select("POLIZA", "PLAN_TECNICO", "PLAZO_CUOTAS").collect()
    assert [tuple(r) for r in got] == [(4780715, 4331, 3), (None, None, None), (None, None, None)]


def test_union_keeps_every_row(spark):
    histories = fx.histories(spark, "/root/testdata/sf0.001")
    assert consolidate(histories).count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


# --------------------------------------------------------------------- rosters


def _sheet(spark, *rows, file="/in/Base Flujo Marzo 2025.xlsx"):
    return spark.createDataFrame([(file, i, list(r)) for i, r in enumerate(rows)], "_file string, _row bigint, cells array<string>")


def test_files_of_one_load_may_differ_in_layout(spark, tmp_path):
    # Three of the thirteen counted columns are filled; two would fall to the trailing rule.
    one = _sheet(spark, ["Folio", "RUT", "Plazo"], ["1", "11", "5"], [None, None, None])
    two = _sheet(spark, ["PLAZO", "rut afiliado", "N° Operación"], ["6", "22", "2"], file="/in/Base Flujo Abril 2025.xlsx")
    load = load_roster(one.unionByName(two), CONTRACTS["flujo"])
    assert sorted((r["foliocredito"], r["rutafiliado"], r["Nombre_de_archivo"]) for r in load.rows.collect()) == [
        (1, 11, "Base Flujo 202503.xlsx"), (2, 22, "Base Flujo 202504.xlsx")]
    assert load.removed["trailing"].count() == 1
    assert {r["columna"]: r["nulos"] for r in load.nulls().collect()}["foliocredito"] == 0
    summary = load_into_history(load, str(tmp_path / "h"))
    assert {r["accion"] for r in summary.collect()} == {"inserción nueva"}
    assert {r["accion"] for r in load_into_history(load, str(tmp_path / "h")).collect()} == {"reemplazo"}
    assert History(spark, str(tmp_path / "h"), "Nombre_de_archivo").read().count() == 2


def test_a_fraction_in_an_identifier_stops_or_empties(spark):
    sheet = _sheet(spark, ["Folio", "RUT", "Plazo"], ["1.5", "11", "5"], ["2", "12", "5"])
    with pytest.raises(Exception, match="not a whole number"):
        load_roster(sheet, CONTRACTS["flujo"]).rows.collect()
    loose = load_roster(sheet, CONTRACTS["flujo"], strict=False).rows
    assert sorted((r["foliocredito"] or 0) for r in loose.collect()) == [0, 2]


def test_twin_columns_are_required(spark):
    with pytest.raises(Exception, match="rut_cliente"):
        load_roster(_sheet(spark, ["RUT Cliente", "Poliza"], ["1-9", "2"]), CONTRACTS["ripley_fraud"]).rows.collect()


def test_interior_blank_rows_stay(spark):
    sheet = _sheet(spark, ["Folio", "RUT", "Plazo"], ["1", "11", "5"], [None, None, None], ["2", "12", "5"])
    assert load_roster(sheet, CONTRACTS["flujo"]).rows.count() == 3


def test_contract_columns_differ_in_more_than_case():
    for contract in CONTRACTS.values():
        lowered = [c.lower() for c in contract.load_columns]
        assert len(set(lowered)) == len(lowered), contract.name


def test_an_audit_is_observed_by_the_load_itself(spark, tmp_path):
    sheet = _sheet(spark, ["Operación", "Rut Deudor", "Prima Ces", "Fecha Ctto"], ["OP-7", "1", "5", "2025-01-05"], ["8", "2", "6", "nunca"], ["OP-9", None, "7", "nunca"])
    load = load_roster(sheet, CONTRACTS["unidad_leasing"])
    summary, audit = load_with_audit(load, str(tmp_path / "h"))
    assert summary.first()["filas"] == 3
    told = {(r["columna"], r["hecho"]): (r["filas"], r["ejemplos"]) for r in audit.collect() if r["filas"]}
    assert told["Operacion2", "cambiado"][0] == 2 and set(told["Operacion2", "cambiado"][1]) == {"OP-7", "OP-9"}
    assert told["Fecha_Ctto", "sin_convertir"] == (2, ["nunca"]) and told["RUT", "nulo"] == (1, [])
    assert History(spark, str(tmp_path / "h"), "NOMBRE_ARCHIVO").read().count() == 3


def test_the_report_reads_only_the_files_it_can_need(spark, tmp_path):
    """A broker that pays a month late, files of unknown months and names without one; folders are pruned while the query runs."""
    names = ["Facturacion_202001.xlsx", "Facturacion_202002.xlsx", "Facturacion_202003.xlsx", "Facturacion_203001.xlsx", "sin mes.xlsx"]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "Nombre_de_archivo string, v int")
    months = spark.sql("select 202000 + m as MES_REF, make_date(2020, m, 1) as PER, add_months(make_date(2020, m, 1), -1) as PER_ANT from (select explode(sequence(1, 4)) as m)")
    period = rep.ReportPeriod("x", 202001, 202002, 202001, 202001, (1,))
    stores = {}
    for name in ("stock", "marsh"):
        stores[name] = History(spark, f"{tmp_path}/{name}", "Nombre_de_archivo")
        stores[name].replace(rows)
    read = rep.reported_histories(stores, months, period)
    assert sorted(r["v"] for r in read["stock"].collect()) == [1, 2, 3, 4]
    # One month late: the file of March is that of February, which the report knows as January;
    # December 2019, told by the first file, is no month of the calendar.
    assert sorted(r["v"] for r in read["marsh"].collect()) == [0, 2, 3, 4]
    plan = read["marsh"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2 and "coalesce(Nombre_de_archivo" in plan


def test_attributes_are_typed_once_per_policy_not_per_premium(premiums, dimensions):
    emitted, *rest = dimensions
    emitted = emitted.withColumn("RUT_INT", F.expr("case CCODCOBE when 'A' then '7' when 'C' then '99999999999' end"))
    df = mon.monitoring(premiums, emitted, *rest, kinds=(mon.DETAIL,))
    plan = df.select("NCORASVS")._jdf.queryExecution().optimizedPlan().toString()
    assert "_early_NCORASVS" in plan
    known = df.where("CCODCOBE is null or CCODCOBE <> 'C'").select("CCODCOBE", "RUT_INT", "NCORASVS").distinct().collect()
    assert {(r[0], r[1] and int(r[1]), r[2] and int(r[2])) for r in known} == {("A", 7, 31), ("B", None, 32), (None, None, None)}
    # What does not fit its column still stops the job, where a premium needs it.
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_INVALID_INPUT"):
        df.select("RUT_INT").collect()
    assert df.where("NNUMDOCU <> 4659577").select("RUT_INT").count() == 2
