"""Every source contract fed from the orders table.

A case says how a sender would lay the orders out (headers as sent, cell texts,
blank rows on top, closing rows) and what must be loaded.  Cell and result
expressions are plain SQL over the same view of orders in both engines:

k, c (keys), x (amount), s (status), pr (priority), p (period text, ten years
ahead), ymd (that day as a number), iso and dmy (as text), serial, nm (a name).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators.relational import map_lookup
from rosterflow.plans.roster import RosterLoad, load_into_history, load_roster, load_with_audit
from rosterflow.queries.registry import cents, cents_sql, query, table
from rosterflow.queries.xlsx import cells_to_workbooks, write_files
from rosterflow.session import fresh_path, settle
from rosterflow.sinks.versioned import History
from rosterflow.sources.contracts import CONTRACTS
from rosterflow.sources.csv import read_csv
from rosterflow.sources.workbook import read_workbooks

_VIEW_SQL = """o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS x, o_orderstatus AS s, o_orderpriority AS pr,
    strftime(d, '%Y%m') AS p, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS ymd, strftime(d, '%Y-%m-%d') AS iso,
    strftime(d, '%d/%m/%Y') AS dmy, d, CAST(datediff('day', DATE '1899-12-30', d) AS BIGINT) AS serial,
    'Cliente ' || o_orderstatus AS nm
  FROM (SELECT *, CAST(o_orderdate + INTERVAL 120 MONTH AS DATE) AS d FROM orders))"""


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 120)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("x"),
        F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("pr"), F.date_format(day, "yyyyMM").alias("p"),
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("ymd"), F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.date_format(day, "dd/MM/yyyy").alias("dmy"),
        F.datediff(day, F.lit("1899-12-30").cast("date")).cast("bigint").alias("serial"),
        F.concat(F.lit("Cliente "), "o_orderstatus").alias("nm"),
    )


# Order keys that go into one workbook of a month: some 25,000 rows; a month with more comes in several, in folders of their own.
WORKBOOK_KEYS = 2_000_000


@dataclass(frozen=True)
class Case:
    source: str
    file: str
    cells: Mapping[str, str]  # header as sent -> cell text; a repeated header gets trailing tabs
    want: Mapping[str, str]  # target -> value; targets not named are null
    blank_top: int = 0
    closing: tuple[Mapping[str, str], ...] = ()  # per closing row: header -> aggregate over the file
    rounded: tuple[str, ...] = field(default=())

    def scanned(self, spark: SparkSession, sf_dir: str, keys_per_file: int | None = None) -> DataFrame:
        base = _view(spark, sf_dir).withColumn("_file", F.expr(self.file))
        if keys_per_file:
            part = F.format_string("/in/parte %d", F.floor(F.col("k") / keys_per_file))
            base = base.withColumn("_file", F.concat(part, F.substring("_file", 4, 1000)))
        array = lambda values: F.array(*values).cast("array<string>")
        data = base.select(
            "_file", (F.col("k") + 1).alias("_row"), array([F.expr(e).cast("string") for e in self.cells.values()]).alias("cells")
        )
        files = base.groupBy("_file").agg(
            F.max("k").alias("last"),
            *[F.expr(e).cast("string").alias(f"a{n}_{i}") for n, row in enumerate(self.closing) for i, e in enumerate(row.values())],
        )
        header = files.select("_file", F.lit(0).cast("bigint").alias("_row"), array([F.lit(h.rstrip("\t")) for h in self.cells]).alias("cells"))
        parts = [data, header]
        for n in range(self.blank_top):
            parts.append(files.select("_file", F.lit(-1 - n).cast("bigint").alias("_row"), array([F.lit("aviso" if i == 0 and n == 0 else None) for i in range(len(self.cells))]).alias("cells")))
        for n, row in enumerate(self.closing):
            at = {h: f"a{n}_{i}" for i, h in enumerate(row)}
            cells = [F.col(at[h]) if h in at else F.lit("" if n % 2 else None) for h in self.cells]
            parts.append(files.select("_file", (F.col("last") + 2 + n).alias("_row"), array(cells).alias("cells")))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        loaded = load_roster(self.scanned(spark, sf_dir), CONTRACTS[self.source]).rows
        return loaded.withColumns({n: cents(F.col(n), 4) for n in self.rounded})

    def sql(self) -> str:
        shown = []
        for name in CONTRACTS[self.source].load_columns:
            value = self.want.get(name, "NULL")
            shown.append(f'{cents_sql("(" + value + ")", 4) if name in self.rounded else value} AS "{name}"')
        return f"WITH {_VIEW_SQL} SELECT " + ", ".join(shown) + " FROM o"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


_DV = "CASE s WHEN 'F' THEN 'k' WHEN 'O' THEN ' 7 ' ELSE '3x' END"
_DV_WANT = "CASE s WHEN 'F' THEN 'K' WHEN 'O' THEN '7' ELSE '3' END"
_PLAIN_DV = "CASE s WHEN 'F' THEN 'k' WHEN 'O' THEN '7' ELSE '3' END"
_RUT = f"(c + 1000000) || '-' || {_PLAIN_DV}"

_BROKER_CELLS = {
    "N° Operación": "k", "AFIRUT": "c", "afirutDV": _DV, "Nombre  Afiliado": "' ' || nm || ' '", "CRECUOTOT": "12",
    "Monto Bruto": "k * 10 || '.0'", "FECINICOB": "ymd", "FecTerCob": "ymd", "Valor Cuota": "k + 5", "Producto": "'nan'",
    "Folio Original": "k + 1", "Fecha Origen": "CASE s WHEN 'P' THEN 'None' ELSE CAST(ymd AS STRING) END",
}
_BROKER_WANT = {
    "foliocredito": "k", "rutafiliado": "c", "dvafiliado": _DV_WANT, "NombreAfiliado": "nm", "Plazo": "12", "MontoBruto": "k * 10",
    "fechaPrimerVto": "ymd", "FechaUltimoVto": "ymd", "ValorCuota": "k + 5", "Producto": "''", "FolioOrigen": "k + 1",
    "FechaOrigen": "CASE s WHEN 'P' THEN NULL ELSE ymd END",
}
_HALF = "x / 2"

CASES = [
    Case(
        "marsh", "'/in/SC Marsh ' || p || '.xlsx'",
        {**_BROKER_CELLS, "Corredora": "'Uno'", "Fecha de Venta": "serial || '.5'", "Fecha de baja": "iso || ' 00:00:00'",
         "Póliza": "7561166", "Prima Bruta Mensual": "x", "PrimaNeta": _HALF},
        {**_BROKER_WANT, "Corredora": "'Uno'", "FECHA_DE_VENTA": "ymd", "FECHA_DE_BAJA": "ymd", "Poliza": "7561166",
         "Prima": "NULL", "Prima_Bruta_mensual": "x", "Prima_Neta": _HALF,
         "Nombre_de_archivo": "'Facturacion_Cesantia_' || p || '.xlsx'"},
        closing=({}, {"Prima Bruta Mensual": "sum(x)", "PrimaNeta": "sum(x / 2)"}),
    ),
    Case(
        "conosur", "'/in/Conosur ' || substr(p, 5, 2) || '-' || substr(p, 1, 4) || '.xlsx'",
        {**_BROKER_CELLS, "Póliza": "6354562", "prima_bruta": "x", "NaN": _HALF},
        {**_BROKER_WANT, "POLIZA": "6354562", "Prima": "x", "PrimaBrutaMensual": "x", "PrimaNetaMensual": _HALF,
         "Nombre_de_archivo": "'Facturacion_Cesantia_' || p || '.xlsx'"},
        blank_top=2, closing=({}, {"N° Operación": "'Promedio'"}),
    ),
    *[
        Case(
            name, f"'/in/Base cesantia SURA {title} ' || p || '.xlsx'",
            {**_BROKER_CELLS, "Prima Cliente": "x", "Prima Exenta": _HALF, "Comisión Caja 25%": "1.5",
             f"Comision Variable {code}": "2", **({"Plan": "'Plan 3 Cuotas'", "Tasa": "0.5"} if name == "planes" else {})},
            {**_BROKER_WANT, "PrimaBruta": "x", "PrimaNeta": _HALF, "Comision25": "1.5", variable: "2", "Planes": "'Plan 3 Cuotas'",
             "Tasa": "0.5", "Nombre_de_archivo":
             "'Facturacion_Cesantia_' || p || '.xlsx'" if name == "planes" else f"'Base cesantia SURA {title} ' || p || '.xlsx'"},
            closing=({}, {"Prima Cliente": "sum(x)", "Prima Exenta": "sum(x / 2)"}),
        )
        for name, title, code, variable in (
            ("flujo", "Flujo", "33", "ComisionVariable"), ("flujo2", "Flujo 2", "26", "ComisionVariable26"),
            ("stock", "Stock", "39", "ComisionVariable"), ("planes", "Planes", "39", "ComisionVariable"),
        )
    ],
    Case(
        "ripley_fraud", "'/in/Fraude ' || p || '.xlsx'",
        {"Fecha Cargo": "CASE s WHEN 'P' THEN dmy ELSE iso || ' 00:00:00' END", "Num Cuota": "'10.5'", "Prima Bruta CLP": "k",
         "Num Propuesta": "k", "RUT Cliente": _RUT, "Seguro": "nm", "Compañia": "'Cia'", "Valor en UF": "x",
         "RUT Cliente\t": "CASE s WHEN 'P' THEN 'sin' ELSE '12.345.678-9' END", "Fecha Vcto": "ymd", "Obs": "'  ok '",
         "Póliza": "77", "UF Bruta": "x", "Afecti": _HALF, "Exento IVA": "x", "Neto": "x"},
        {"FECHA_CARGO": "CASE s WHEN 'P' THEN NULL ELSE ymd END", "NUM_CUOTA": "10", "CUOTA_PRIMA": "k", "PROPUESTA_COM": "k",
         "RUT_DEUDOR": "c + 1000000", "DV_DEUDOR": f"upper({_PLAIN_DV})", "SEGURO": "nm", "COMPANIA": "'Cia'", "PRIMA_UF": "x",
         "RUT_CLIENTE": "CASE s WHEN 'P' THEN NULL ELSE 12345678 END", "DV_CLIENTE": "CASE s WHEN 'P' THEN NULL ELSE '9' END",
         "FECHA_VCTO": "ymd", "OBSERVACION": "'ok'", "POLIZA": "77", "NOMBRE_ARCHIVO": "'Base Fraude RIPLEY ' || p || '.xlsx'",
         "ANO_MES_CARGA": "CAST(p AS BIGINT)", "PRIMA_NETA_UF": "x / 1.19::DOUBLE"},
        closing=({"UF Bruta": "sum(x)", "Afecti": "sum(x / 2)", "Exento IVA": "sum(x)", "Neto": "sum(x)"},),
        rounded=("PRIMA_NETA_UF",),
    ),
    Case(
        "itau_fraud", "'/in/BBDD ' || p || '.xlsx'",
        {"Nro Cliente": "c", "RUT": "'0' || " + _RUT, "Nombre": "nm", "FechaCobro": "CASE s WHEN 'F' THEN dmy WHEN 'O' THEN CAST(serial AS STRING) ELSE ymd || '.0' END",
         "MedioDePago": "k", "Monto": "k || '.5'", "KIT": "'ABC'", "Producto": "'P'", "Prima UF": "x", "Vigencia": "iso",
         "Compañía": "'Banco'", "Fecha Nacimiento": "CASE s WHEN 'P' THEN '99999' ELSE dmy END", "Posee AP": "1", "Mes": "3", "Año": "2025",
         "Mes Año": "'3-2025'", "Prima Neta": _HALF, "UF": "k"},
        {"Cliente": "c", "RUT": "c + 1000000", "DVRUT": f"upper({_PLAIN_DV})", "NOMBRE": "nm", "FECHACOBRO": "ymd", "CodigoPago": "k",
         "Monto": "CASE WHEN k % 2 = 0 THEN k ELSE k + 1 END", "KIT": "'AB'", "Producto": "'P'", "Prima_UF": "x", "Vigencia": "ymd",
         "PARTNER_BANCO": "'Banco'", "Fecha_Nacimiento": "CASE s WHEN 'P' THEN NULL ELSE ymd END", "Posee_IVA": "1", "MES": "3",
         "AÑO": "2025", "MES_AÑO": "'3-2025'", "Prima_Neta": _HALF, "UF": "k", "NOMBRE_ARCHIVO": "'Bases Fraude ' || p || '.xlsx'"},
    ),
    Case(
        "servihabit", "'/in/Nomina ' || p || '.xlsx'",
        {"Guía": "k", "Nro Operación": "k + 2", "S.V.S": "9", "Dueño": "nm", "Serie R.U.T": _RUT, "Cliente": "nm", "Plazo Meses": "24",
         "Cuota": "x", "Total Prima": "k", "IVA": "1.5", "Póliza": "88", "Plan Técnico": "4280", "Nombre Archivo": "' '",
         "Mes Recaudación": "CASE WHEN p LIKE '2006%' THEN 'enero' ELSE '' END"},
        {"Guia": "k", "Operacion": "k + 2", "SVS": "9", "Dueno": "nm", "Rut": _RUT, "Cliente": "nm", "Plazo": "24", "Cuota": "x",
         "Total_Prima_uf": "k", "Iva_clp": "1.5", "Poliza": "88", "Plan_Tecnico": "4280", "NOMBRE_ARCHIVO": "p || ' Nomina Cesantia.xlsx'",
         "MES_RECAUDACION": "CASE WHEN p LIKE '2006%' THEN 'enero' ELSE p END", "rut2": "c + 1000000", "dv2": f"upper({_PLAIN_DV})"},
    ),
    Case(
        "concreces", "'/in/CONCRECES ' || p || '.xlsx'",
        {"Guia": "k", "Operación": "'BCH000' || k", "Póliza": "CASE s WHEN 'F' THEN '8598974' WHEN 'O' THEN '8598972' ELSE '1' END",
         "Serie R.U.T": "c", "Dígito R.U.T": _DV, "Fecha Nacimiento": "iso", "Fecha de Escritura": "'sin'", "Plazo (No años)": "15",
         "Factor": "0.25", "Prima UF": "x", "Prima Pesos": "k", "Fecha Conversión": "iso || ' 00:00:00'", "Capital Asegurado": "k * 2",
         "Saldo Insoluto": _HALF},
        {"Guia": "k", "Operacion": "'BCH000' || k", "Poliza": "CASE s WHEN 'F' THEN 8598974 WHEN 'O' THEN 8598972 ELSE 1 END", "RUT": "c",
         "DV": _DV_WANT, "Fecha_Nacimiento": "d", "Plazos_Anuales": "15", "Factor": "0.25", "Prima_UF": "x", "Prima_Pesos": "k",
         "Fecha_Conversion": "d", "Capital": "k * 2", "Saldo_Insoluto": _HALF,
         "Plan_Tecnico": "CASE s WHEN 'F' THEN 4783 WHEN 'O' THEN 4780 END", "NOMBRE_ARCHIVO": "p || ' CONCRECES Nominas cesantia.xlsx'",
         "MES_RECAUDACION": "CAST(p AS BIGINT)", "Operacion2": "k"},
    ),
    Case(
        "unidad_leasing", "'/in/UL ' || p || '.xlsx'",
        {"": "k", "Operación": "'OP-' || k", "Oper. Unidad": "'U' || c || ' '", "Rut Deudor": "c", "DV": _DV, "Comuna": "nm",
         "Nro Póliza": "99", "Prima Ces": "x", "Fecha Ctto": "iso", "Fecha Vcmto": "'1700-01-01'", "Seg Ces": _HALF, "Tot Cupon c/Seg": "k"},
        {"Guia": "k", "Operacion": "'OP-' || k", "Oper_Unidad": "'U' || c", "RUT": "c", "DV": _DV_WANT, "Comuna": "nm", "Poliza": "99",
         "Prima_Ces": "x", "Fecha_Ctto": "d", "Prima_Bruta_PPI": _HALF, "Monto_Asegurado": "k",
         "NOMBRE_ARCHIVO": "'UNIDAD LEASING - Cesantia - ' || p || '.xlsx'", "Operacion2": "k", "Oper_Unidad2": "c",
         "MES_RECAUDACION": "CAST(p AS BIGINT)"},
        closing=({"Comuna": "'TOTALES'", "Prima Ces": "sum(x)"},),
    ),
    Case(
        "colmena", "'/in/Maestro ' || substr(p, 1, 4) || '.' || substr(p, 5, 2) || '.xlsx'",
        {"Folio": "k", "RUT Titular": "c", "DV": _DV, "ID Producto": "CASE s WHEN 'F' THEN '69' WHEN 'O' THEN '71' ELSE '70.0' END",
         "Producto": "nm", "Costo Total": "x", "Fec Nacimiento": "iso", "Fecha Suscripción": "CASE s WHEN 'P' THEN '' ELSE iso END", "Monto Prima": _HALF},
        {"Guia": "k", "RUT": "c", "DV": _DV_WANT, "ID_Producto": "CASE s WHEN 'F' THEN 69 WHEN 'O' THEN 71 ELSE 70 END", "Producto": "nm",
         "Costo_Total": "x", "Fecha_Nacimiento": "d", "Fecha_Suscripcion": "CASE s WHEN 'P' THEN NULL ELSE d END", "Prima_UF": _HALF,
         "Poliza": "CASE s WHEN 'F' THEN 7391284 WHEN 'O' THEN 7391286 END", "NOMBRE_ARCHIVO": "p || ' Cesantia Plus.xlsx'",
         "MES_RECAUDACION": "CAST(p AS BIGINT)", "Fecha_Nac": "ymd", "Fecha_Sus": "CASE s WHEN 'P' THEN NULL ELSE ymd END"},
    ),
    Case(
        "los_heroes", "'/in/' || p || '/Nomina ' || CASE s WHEN 'F' THEN '1234567' ELSE '7654321x' END || '.xlsx'",
        {"Num Operación": "k || '.9'", "RUT": "(c + 1000000) || '.'", "Dígito Verificador": "' k '", "Tipo de Cliente": "nm", "Prima Bruta": "k || ',5'",
         "Moneda": "'UF'", "Cliente": "nm", "Prima Neta": "k / 4", "Plazo": "'x'", "Tramo": "''", "Fecha Venta": "CASE s WHEN 'P' THEN CAST(serial AS STRING) ELSE dmy END",
         "Monto Crédito": "k", "Monto Cuota": "'-'", "Prima": "'fuera de rango'"},
        {"Mes_Referencia": "CAST(p AS BIGINT)", "Poliza": "CASE s WHEN 'F' THEN '1234567' ELSE '7654321' END", "Numero_Operacion": "k",
         "RUT": _text("c + 1000000"), "DV_RUT": "'K'", "Tipo_Cliente": "nm", "PRIMA": "k || '.50'", "tipo_Moneda": "'UF'", "Nombre_Asegurado": "nm",
         "Prima_Neta": "(k // 4) || CASE k % 4 WHEN 0 THEN '.00' WHEN 1 THEN '.25' WHEN 2 THEN '.50' ELSE '.75' END", "Tramo": "''",
         "Mes_venta": "iso", "Monto_Credito": "k || '.00'"},
    ),
    Case(
        "ripley_life", "'/in/Vida ' || p || '.xlsx'",
        {"Nro Cuota": "3", "Cuota Prima": "x", "Propuesta_com": "k", "Seguro": "nm", "RUT Cliente": f"(c + 1000000) || {_PLAIN_DV}",
         "Fecha Cargo": "iso", "Fecha Vcto": "iso || ' 00:00:00'", "Vida": "'V'"},
        {"NUM_CUOTA": "'3'", "PRIMA_BRUTA_CLP": _text("x"), "PROPUESTA_COM": _text("k"), "SEGURO": "nm", "RUT CLIENTE": f"(c + 1000000) || {_PLAIN_DV}",
         "RUT": "c + 1000000", "DV_RUT": f"upper({_PLAIN_DV})", "FECHA_CARGO": "d", "FECHA VCTO": "CAST(ymd AS DOUBLE)", "VIDA": "'V'",
         "NUMERO_ARCHIVO": "p", "NOMBRE_ARCHIVO": "'Vida ' || p || '.xlsx'"},
    ),
]

for _case in CASES:
    query(_case.sql(), name=f"roster_{_case.source}")(_case.run)


@query(f"""WITH {_VIEW_SQL}
SELECT CAST(k AS STRING) AS "PROPUESTA", dmy AS "FECHA_PAGO", {_RUT} AS "RUTAFILIADO", nm AS "NOMBREAFILIADO", NULL AS "CUOTA",
  CAST(x AS STRING) AS "VALOR_CUOTA_BRUTO_CLP", 'remesa_' || strftime(CAST(d - INTERVAL 1 MONTH AS DATE), '%Y%m') || '.csv' AS "NOMBRE_ARCHIVO"
FROM o""")
def roster_banigualdad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named columns instead of cells; the key is the month before the file's date."""
    raw = _view(spark, sf_dir).select(
        F.expr("'/in/remesa_' || p || '15.csv'").alias("_file"), F.col("k").alias("_row"), F.col("k").cast("string").alias("numero_propuesta"),
        F.col("dmy").alias("fecha_de_pago"), F.expr(_RUT).alias("rut_afiliado"), F.col("nm").alias("nombre_afiliado"),
        F.col("x").cast("string").alias("valor_cuota_bruto_pesos"), F.lit(" ").alias("nombre_archivo"),
    )
    return load_roster(raw, CONTRACTS["banigualdad"]).rows


@query(f"""WITH {_VIEW_SQL}, files AS (SELECT 'Base cesantia SURA Stock ' || p || '.xlsx' AS f, count(*) AS n FROM o GROUP BY ALL)
SELECT f AS "Nombre_de_archivo", n AS filas, CASE WHEN f < 'Base cesantia SURA Stock 2008' THEN n ELSE 0 END AS filas_previas,
  CASE WHEN f < 'Base cesantia SURA Stock 2008' THEN 'reemplazo' ELSE 'inserción nueva' END AS accion, n AS en_historia
FROM files""")
def roster_history_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan to history, twice: the first load brings the early files, the second all of them."""
    stock = next(c for c in CASES if c.source == "stock")
    scanned, path = stock.scanned(spark, sf_dir), fresh_path(spark, "history")
    load = load_roster(scanned, CONTRACTS["stock"])
    early = load.rows.where(F.col("Nombre_de_archivo") < "Base cesantia SURA Stock 2008")
    load_into_history(RosterLoad(load.contract, early), path)
    summary = load_into_history(load, path)
    stored = History(spark, path, "Nombre_de_archivo").read().groupBy("Nombre_de_archivo").agg(F.count("*").alias("en_historia"))
    return summary.join(stored, "Nombre_de_archivo")


# ------------------------------------------------- from files to the history


def _from_files(case: Case, spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The case's rows written as real workbooks, then scanned as its contract says."""
    contract = CONTRACTS[case.source]
    scanned = case.scanned(spark, sf_dir, WORKBOOK_KEYS)
    # A preferred sheet is found by its name, whatever its case and place; else the place counts.
    sheet = f" {contract.sheets[-1].upper()} " if contract.sheets else "Hoja"
    moved = scanned.withColumn("_file", F.concat(F.lit(folder), F.substring("_file", 4, 1000)))
    write_files(cells_to_workbooks(moved, sheet, contract.sheet_index)).collect()
    return read_workbooks(spark, folder, preferred=contract.sheets, fallback=contract.sheet_index, recursive=True)


def _through_history(load: RosterLoad, spark: SparkSession, path: str) -> DataFrame:
    """Loaded twice, which must change nothing, and read back in the load's types; typed once."""
    typed = RosterLoad(load.contract, settle(load.rows, "typed"))
    for _ in range(2):
        summary = load_into_history(typed, path)
    wrong = summary.where("filas <> filas_previas or accion <> 'reemplazo'").count()
    if wrong:
        raise AssertionError(f"{wrong} files are not replaced by themselves")
    stored, want = History(spark, path, load.contract.key).read(), load.rows.schema
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want])


def _file_query(case: Case):
    # A header that reads "NaN" is a blank cell in a file.
    case = replace(case, cells={"Prima Neta" if h == "NaN" else h: v for h, v in case.cells.items()})

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, path = fresh_path(spark, f"in-{case.source}"), fresh_path(spark, case.source)
        loaded = load_roster(_from_files(case, spark, sf_dir, folder), CONTRACTS[case.source])
        rows = _through_history(loaded, spark, path)
        return rows.withColumns({n: cents(F.col(n), 4) for n in case.rounded})

    run.__doc__ = f"Files of {case.source}, as sent, to the history table and back."
    return run


for _case in CASES:
    query(_case.sql(), name=f"file_{_case.source}")(_file_query(_case))


_REMITTANCE_SQL = f"""WITH {_VIEW_SQL}
SELECT CAST(k AS STRING) AS "PROPUESTA", dmy AS "FECHA_PAGO", {_RUT} AS "RUTAFILIADO", nm AS "NOMBREAFILIADO", NULL AS "CUOTA",
  CAST(x AS STRING) AS "VALOR_CUOTA_BRUTO_CLP", 'remesa_' || strftime(CAST(d - INTERVAL 1 MONTH AS DATE), '%Y%m') || '.csv' AS "NOMBRE_ARCHIVO"
FROM o"""


@query(_REMITTANCE_SQL)
def file_banigualdad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a space, ``%``, ``+`` and ``[`` in their names, to the history table and back."""
    columns = {
        "Número Propuesta": F.col("k").cast("string"), "Fecha de Pago": F.col("dmy"), "RUT Afiliado": F.expr(_RUT), "Nombre Afiliado": F.col("nm"),
        "Cuota": F.lit(""), "Valor Cuota Bruto Pesos": F.col("x").cast("string"),
    }
    folder, path = fresh_path(spark, "in-banigualdad"), fresh_path(spark, "banigualdad")
    lines = _view(spark, sf_dir).select(
        F.concat(F.lit(f"{folder}/100%20 [a+b]/remesa "), "p", F.lit("15.csv")).alias("path"), F.col("k"),
        F.concat_ws(";", *columns.values()).alias("line"),
    )
    head = F.lit(";".join(columns) + "\n")
    files = lines.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n").alias("body"))
    write_files(files.select("path", F.encode(F.concat(head, "body"), "UTF-8").alias("content"))).collect()
    loaded = load_roster(read_csv(spark, folder), CONTRACTS["banigualdad"])
    return _through_history(loaded, spark, path)


@query(f"""WITH {_VIEW_SQL}
SELECT 'rut' AS tabla, CAST(c + 1000000 AS STRING) || 'x' AS clave, count(*) AS filas FROM o WHERE s = 'P' GROUP BY 2
UNION ALL SELECT 'producto', CAST(k % 3 + 80 AS STRING), count(*) FROM o WHERE s = 'O' GROUP BY 2""")
def roster_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load's audit lists: identifiers of no valid shape, and products that the table of policies lacks."""
    view = _view(spark, sf_dir)
    rut = F.when(F.col("s") == "P", F.concat(F.col("c") + 1000000, F.lit("x"))).otherwise((F.col("c") + 1000000).cast("string"))
    product = F.when(F.col("s") == "O", F.col("k") % 3 + 80).otherwise(69)
    rows = map_lookup(view.select(rut.alias("RUT"), product.alias("ID")), "ID", "Poliza", {"69": 7391284})
    load = RosterLoad(CONTRACTS["colmena"], rows)
    wrong = load.suspects("RUT").select(F.lit("rut").alias("tabla"), F.col("valor").alias("clave"), "filas")
    return wrong.unionByName(load.unmapped("ID", "Poliza").select(F.lit("producto").alias("tabla"), F.col("ID").cast("string").alias("clave"), "filas"))


@query(f"""WITH {_VIEW_SQL}, f AS (
  SELECT 'itau_fraud' AS fuente, 'Fecha_Nacimiento' AS columna, 'sin_convertir' AS hecho, s = 'P' AS tiene, '99999' AS texto FROM o
  UNION ALL SELECT 'itau_fraud', 'Monto', 'con_decimales', true, NULL FROM o
  UNION ALL SELECT 'itau_fraud', 'Prima_NETA_UF', 'nulo', true, NULL FROM o
  UNION ALL SELECT 'concreces', 'Operacion2', 'cambiado', true, NULL FROM o
  UNION ALL SELECT 'concreces', 'Fecha_Escritura', 'sin_convertir', true, 'sin' FROM o
  UNION ALL SELECT 'concreces', 'Plan_Tecnico', 'sin_convertir', s = 'P', '1' FROM o
  UNION ALL SELECT 'unidad_leasing', 'Fecha_Vcmto', 'sin_convertir', true, '1700-01-01' FROM o
  UNION ALL SELECT 'unidad_leasing', 'Operacion2', 'cambiado', true, NULL FROM o
  UNION ALL SELECT 'unidad_leasing', 'Oper_Unidad2', 'cambiado', true, NULL FROM o)
SELECT fuente, columna, hecho, count(*) AS filas, CASE WHEN any_value(texto) IS NULL THEN '' ELSE any_value(texto) END AS ejemplo,
  (SELECT count(*) FROM o) AS en_historia
FROM f WHERE tiene GROUP BY ALL""")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads of three sources tell while they are written: unread dates, rounded fractions, changed operation numbers, nulls."""
    found = []
    for case in CASES:
        if case.source not in ("itau_fraud", "concreces", "unidad_leasing"):
            continue
        load, path = load_roster(case.scanned(spark, sf_dir), CONTRACTS[case.source]), fresh_path(spark, "audited")
        summary, audit = load_with_audit(load, path)
        loaded = summary.agg(F.sum("filas").alias("en_historia"))
        one = F.when((F.size("ejemplos") == 1) & (F.col("hecho") == "sin_convertir"), F.get("ejemplos", F.lit(0))).otherwise("")
        found.append(audit.where("filas > 0").select(F.lit(case.source).alias("fuente"), "columna", "hecho", "filas", one.alias("ejemplo")).join(F.broadcast(loaded)))
    return reduce(DataFrame.unionByName, found)
