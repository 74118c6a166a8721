"""Row cleaning over events and line items seen as rosters.

Every event type is a file whose rows are ordered by event id.  Low values stand
for blank cells, so the rules meet real gaps; totals are derived from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators import headers, rows
from rosterflow.queries.registry import query, table

# A cell is blank when the value (or its hundredths) is low; the first and last rows are emptied.
_ROSTER_SQL = """edges AS (SELECT event_type, min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY event_type),
roster AS (
  SELECT e.event_type AS file, e.event_id AS row,
    CASE WHEN e.event_id IN (lo, hi) OR value < 20 THEN NULL ELSE 'U' || user_id END AS a,
    CASE WHEN e.event_id IN (lo, hi) OR value < 15 THEN ' nan ' ELSE props END AS b,
    CASE WHEN e.event_id IN (lo, hi) OR value < 10 THEN '' ELSE CAST(value AS VARCHAR) END AS c,
    CASE WHEN e.event_id IN (lo, hi) OR value < 5 THEN 'None' ELSE 'x' END AS d,
    CASE WHEN e.event_id IN (lo, hi) OR value < 2 THEN '  ' ELSE 'y' END AS e
  FROM events e JOIN edges USING (event_type)),
rated AS (
  SELECT *, ((a IS NULL)::INT + (lower(trim(b)) IN ('', 'none', 'nan'))::INT + (lower(trim(c)) IN ('', 'none', 'nan'))::INT
    + (lower(trim(d)) IN ('', 'none', 'nan'))::INT + (lower(trim(e)) IN ('', 'none', 'nan'))::INT) / 5.0 AS ratio,
    row_number() OVER (PARTITION BY file ORDER BY row) AS n
  FROM roster)"""


def _roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    edges = events.groupBy("event_type").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    edge = F.col("event_id").isin(F.col("lo"), F.col("hi"))

    def cell(limit: float, blank: str | None, value: Column) -> Column:
        return F.when(edge | (F.col("value") < limit), F.lit(blank)).otherwise(value)

    return events.join(edges, "event_type").select(
        F.col("event_type").alias("_file"), F.col("event_id").alias("_row"),
        cell(20, None, F.concat(F.lit("U"), "user_id")).alias("a"), cell(15, " nan ", F.col("props")).alias("b"),
        cell(10, "", F.col("value").cast("string")).alias("c"), cell(5, "None", F.lit("x")).alias("d"),
        cell(2, "  ", F.lit("y")).alias("e"),
    )


@query(f"""WITH {_ROSTER_SQL}
SELECT file, row, ratio::DOUBLE AS ratio FROM rated""")
def row_null_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _roster(spark, sf_dir)
    return df.select(F.col("_file").alias("file"), F.col("_row").alias("row"), rows.row_ratio(df).alias("ratio"))


_LEAD_SQL = f"""{_ROSTER_SQL},
lead AS (SELECT file, min(n) FILTER (WHERE ratio <= 0.8) AS first_kept FROM rated WHERE n <= 2 GROUP BY file),
flagged AS (SELECT r.*, n < coalesce(first_kept, 3) AS gone FROM rated r JOIN lead USING (file))"""


@query(f"WITH {_LEAD_SQL} SELECT file, row FROM flagged WHERE NOT gone")
def trim_leading(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _roster(spark, sf_dir)
    kept, _ = rows.split_leading(df, rows.row_ratio(df))
    return kept.select(F.col("_file").alias("file"), F.col("_row").alias("row"))


_TRAIL_SQL = f"""{_ROSTER_SQL},
tail AS (SELECT file, max(n) FILTER (WHERE ratio < 0.8) AS last_kept FROM rated GROUP BY file),
flagged AS (SELECT r.*, n > coalesce(last_kept, 0) AS gone FROM rated r JOIN tail USING (file))"""


@query(f"WITH {_TRAIL_SQL} SELECT file, row FROM flagged WHERE NOT gone")
def trim_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _roster(spark, sf_dir)
    kept, _ = rows.split_trailing(df, rows.row_ratio(df))
    return kept.select(F.col("_file").alias("file"), F.col("_row").alias("row"))


@query(f"""WITH {_LEAD_SQL.replace('flagged', 'flagged_lead')}, tail AS (
  SELECT file, max(n) FILTER (WHERE ratio < 0.8) AS last_kept FROM rated GROUP BY file)
SELECT 'leading' AS rule, file, row FROM flagged_lead WHERE gone
UNION ALL SELECT 'trailing', r.file, row FROM rated r JOIN tail USING (file) WHERE n > coalesce(last_kept, 0)""")
def removed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both rules take out, kept for audit."""
    df = _roster(spark, sf_dir)
    shown = [F.col("_file").alias("file"), F.col("_row").alias("row")]
    _, leading = rows.split_leading(df, rows.row_ratio(df))
    _, trailing = rows.split_trailing(df, rows.row_ratio(df))
    return leading.select(F.lit("leading").alias("rule"), *shown).unionByName(
        trailing.select(F.lit("trailing").alias("rule"), *shown)
    )


# ------------------------------------------------------------------- total rows


def _with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority, each file ending in a total row; the urgent one's total is wrong."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("_file"), F.col("o_orderkey").alias("_row"),
        F.col("o_totalprice").cast("string").alias("uf"), (F.col("o_totalprice") / 4).cast("string").alias("neto"),
        F.col("o_custkey").cast("string").alias("cliente"), F.col("o_orderstatus").alias("estado"),
    )
    sums = orders.groupBy("_file").agg(
        F.max("_row").alias("m"), F.sum(F.col("uf").cast("double")).alias("s"), F.sum(F.col("neto").cast("double")).alias("t")
    )
    factor = F.when(F.col("_file") == "1-URGENT", 1.01).otherwise(1.0)
    total = sums.select(
        "_file", (F.col("m") + 1).alias("_row"), (F.col("s") * factor).cast("string").alias("uf"),
        F.col("t").cast("string").alias("neto"), F.lit("").alias("cliente"),
        F.when(F.col("_file") == "5-LOW", "Total general").alias("estado"),
    )
    return orders.unionByName(total)


@query("""
SELECT o_orderpriority AS file, count(*) + (o_orderpriority IN ('1-URGENT', '5-LOW'))::INT AS filas,
  max(o_orderkey) + (o_orderpriority IN ('1-URGENT', '5-LOW'))::INT AS ultima
FROM orders GROUP BY o_orderpriority""")
def drop_total_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wrong total stays; so does the one that says more than 20% of its other cells."""
    kept, _ = rows.split_total(_with_totals(spark, sf_dir), {"uf": 4, "neto": 4})
    return kept.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("filas"), F.max("_row").alias("ultima"))


@query("""
SELECT o_orderpriority AS archivo, o_orderpriority <> '1-URGENT' AS footer_eliminado,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN max(o_orderkey) + 1 END AS indice_footer,
  CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN 'keyword_match' ELSE 'numeric_sum_match' END AS motivo
FROM orders GROUP BY o_orderpriority""")
def footer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_totals(spark, sf_dir)
    amounts = {c: rows.to_number(F.col(c)) for c in ("uf", "neto")}
    _, _, audit = rows.split_footer(df, amounts)
    return audit


@query("""
SELECT o_orderpriority AS file, count(*) + (o_orderpriority = '1-URGENT')::INT AS filas,
  max(o_orderkey) + (o_orderpriority = '1-URGENT')::INT AS ultima
FROM orders GROUP BY o_orderpriority""")
def drop_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_totals(spark, sf_dir)
    kept, _, _ = rows.split_footer(df, {c: rows.to_number(F.col(c)) for c in ("uf", "neto")})
    return kept.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("filas"), F.max("_row").alias("ultima"))


# -------------------------------------------------------------- header operators


@query("""
SELECT c_custkey, c_name AS rut, c_mktsegment AS segmento, NULL AS ausente, 'CL' AS pais,
  coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, c_name) AS primero
FROM customer""")
def pick_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy headers made technical, then resolved by synonyms."""
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("N° Operación"), F.col("c_name").alias(" RUT Cliente "),
        F.col("c_mktsegment").alias("Segmento-Mercado"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("Segmento Mercado"),
    )
    df = headers.normalize_columns(raw)
    picked = df.select(
        headers.pick(df, "no_operacion", "n_operacion", required=True).alias("c_custkey"),
        headers.pick(df, "rut", "rut_cliente").alias("rut"), headers.pick(df, "segmento_mercado").alias("segmento"),
        headers.pick(df, "nada", "ninguno").alias("ausente"), headers.pick(df, "pais", default="CL").alias("pais"),
        headers.pick_filled(df, "otra", "segmento_mercado_2", "rut_cliente").alias("primero"),
    )
    return headers.keep_columns(picked, ["c_custkey", "no_existe", "rut", "segmento", "ausente", "pais", "primero"])


@query("""
WITH groups AS (SELECT event_type, max(value) > 400 AS has FROM events GROUP BY event_type)
SELECT event_id, CASE WHEN has THEN CASE WHEN value > 400 THEN 'dato' ELSE ' ' END ELSE event_type || '.csv' END AS nombre
FROM events JOIN groups USING (event_type)""")
def fill_blank_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column filled only for the files that leave it wholly empty."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("_file"), F.when(F.col("value") > 400, "dato").otherwise(" ").alias("nombre")
    )
    filled = headers.fill_if_all_blank(events, "nombre", F.concat("_file", F.lit(".csv")), per="_file")
    return filled.select("event_id", "nombre")


@query("""
SELECT o_orderpriority AS file, o_orderkey AS n_operacion, o_orderstatus AS estado,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_custkey AS VARCHAR) END AS col_3
FROM orders""")
def header_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's first row is its header; layouts differ between files."""
    orders = table(spark, sf_dir, "orders")
    three = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    cells = F.when(three, F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_custkey").cast("string"))).otherwise(
        F.array(F.col("o_orderstatus"), F.col("o_orderkey").cast("string"))
    )
    data = orders.select(F.col("o_orderpriority").alias("_file"), F.col("o_orderkey").alias("_row"), cells.alias("cells"))
    heads = orders.select(F.col("o_orderpriority").alias("_file")).distinct().select(
        "_file", F.lit(-1).cast("bigint").alias("_row"),
        F.when(F.col("_file").isin("1-URGENT", "2-HIGH"), F.array(F.lit("N° Operación"), F.lit("Estado"), F.lit("")))
        .otherwise(F.array(F.lit("ESTADO "), F.lit("n_operacion"))).alias("cells"),
    )
    scanned = data.unionByName(heads)
    resolved = headers.named_rows(scanned, headers.header_table(scanned, promoted=True), {
        n: headers.position(F.col("names"), n) for n in ("n_operacion", "estado", "col_3")
    })
    return resolved.select(
        F.col("_file").alias("file"), F.col("n_operacion").cast("bigint").alias("n_operacion"), "estado", "col_3"
    )
