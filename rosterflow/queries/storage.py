"""History maintenance, scans and the incremental load; each writes to a fresh shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators import quality, relational
from rosterflow.queries.registry import ORACLES, cents, cents_sql, query, table
from rosterflow.session import fresh_path, settle
from rosterflow.sinks import export, history
from rosterflow.sinks.versioned import History
from rosterflow.sources import csv, tables, workbook
from rosterflow.streaming.landing import land_and_wait

KEY = "archivo"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the monthly file that brought them."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
        F.date_format("o_orderdate", "'remesa_'yyyyMM'.csv'").alias(KEY),
    )


_ORDERS_SQL = """o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
  'remesa_' || strftime(o_orderdate, '%Y%m') || '.csv' AS archivo FROM orders)"""


@query(f"""WITH {_ORDERS_SQL}
SELECT archivo, o_orderkey, CASE WHEN archivo LIKE 'remesa_1998%' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM o WHERE NOT (archivo LIKE 'remesa_1998%' AND o_orderstatus = 'P')""")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of files is sent again with other amounts and fewer rows; sent twice, the result is the same."""
    path = fresh_path(spark, "replace")
    orders = _orders(spark, sf_dir)
    history.replace_partition(orders, path, KEY)
    resent = orders.where(F.col(KEY).startswith("remesa_1998") & (F.col("o_orderstatus") != "P")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    history.replace_partition(resent, path, KEY)
    history.replace_partition(resent, path, KEY)
    return history.read_history(spark, path).select(KEY, "o_orderkey", "o_totalprice")


@query(f"""WITH {_ORDERS_SQL}, kept AS (
  SELECT archivo, o_orderstatus, 'primera' AS carga FROM o WHERE archivo NOT IN ('remesa_199801.csv', 'remesa_199802.csv')
  UNION ALL SELECT archivo, o_orderstatus, 'segunda' FROM o WHERE o_orderstatus = 'F' AND archivo IN ('remesa_199802.csv', 'remesa_199803.csv'))
SELECT archivo, carga, count(*) AS filas FROM kept GROUP BY archivo, carga""")
def replace_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files lose their rows even when nothing replaces them; unlisted ones are appended to."""
    table_ = History(spark, fresh_path(spark, "listed"), KEY)
    orders = _orders(spark, sf_dir)
    table_.replace(orders.withColumn("carga", F.lit("primera")))
    again = orders.where((F.col("o_orderstatus") == "F") & F.col(KEY).isin("remesa_199802.csv", "remesa_199803.csv"))
    table_.replace(again.withColumn("carga", F.lit("segunda")), ["remesa_199801.csv", "remesa_199802.csv"])
    return table_.read().groupBy(KEY, "carga").agg(F.count("*").alias("filas"))


_TYPED_SQL = """t AS (SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS periodo, o_orderkey FROM orders),
f(forma, lote) AS (VALUES ('carpeta', 'texto'), ('carpeta', 'entero'), ('versiones', 'texto'), ('versiones', 'entero'))"""


@query(f"""WITH {_TYPED_SQL}
SELECT forma, lote, CAST(periodo AS VARCHAR) AS periodo, count(*) AS filas FROM t, f WHERE periodo <> 199802 GROUP BY ALL""")
def replace_listed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of numbers for keys of text, and of text for numbers, names the same partitions: what is sent stays, what is not goes."""
    period = F.date_format("o_orderdate", "yyyyMM")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", period.alias("periodo"))
    found = []
    for lot, rows, listed in (
        ("texto", orders, [199801, 199802]), ("entero", orders.withColumn("periodo", F.col("periodo").cast("bigint")), ["199801", " 199802"]),
    ):
        folder, versions = fresh_path(spark, "typed"), History(spark, fresh_path(spark, "typed"), "periodo")
        again = rows.where("periodo = 199801")
        history.replace_partition(rows, folder, "periodo")
        history.replace_partition(again, folder, "periodo", listed)
        versions.replace(rows)
        versions.replace(again, listed)
        for form, stored in (("carpeta", history.read_history(spark, folder)), ("versiones", versions.read())):
            found.append(stored.select(F.lit(form).alias("forma"), F.lit(lot).alias("lote"), "periodo"))
    return reduce(DataFrame.unionByName, found).groupBy("forma", "lote", "periodo").agg(F.count("*").alias("filas"))


@query(f"""WITH {_ORDERS_SQL}
SELECT archivo, o_orderkey, n::INTEGER AS carga FROM o, (VALUES (1), (2)) v(n) WHERE archivo IS NOT NULL""")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "append")
    for n in (1, 2):
        history.append(_orders(spark, sf_dir).withColumn("carga", F.lit(n)), path, KEY)
    return history.read_history(spark, path).select(KEY, "o_orderkey", "carga")


@query(f"WITH {_ORDERS_SQL} SELECT archivo, o_orderkey FROM o WHERE o_orderstatus = 'O'")
def truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "truncate")
    history.append(_orders(spark, sf_dir), path, KEY)
    history.truncate_and_load(_orders(spark, sf_dir).where("o_orderstatus = 'O'"), path, KEY)
    return history.read_history(spark, path).select(KEY, "o_orderkey")


@query("""
SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey END AS clave,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_acctbal + 1 ELSE c_acctbal END AS saldo, c_name AS nombre
FROM customer WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT c_custkey, c_acctbal + 1, NULL FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT NULL, c_acctbal, NULL FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows change the sent column and keep the other; null keys are inserted, never matched.

    On a versioned history, of which only the partitions with a match are written anew.
    """
    target, stage = _upserted(spark, sf_dir)
    table_ = History(spark, fresh_path(spark, "upsert"), "zona")
    table_.replace(target.withColumn("zona", F.coalesce(F.col("clave") % 7, F.lit(7))))
    table_.upsert(stage, ["clave"])
    return table_.read().drop("zona")


def _upserted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A target and what is merged into it."""
    customers = table(spark, sf_dir, "customer")
    key = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey")).alias("clave")
    target = customers.where("c_mktsegment <> 'MACHINERY'").select(
        key, F.col("c_acctbal").alias("saldo"), F.col("c_name").alias("nombre")
    )
    changed = customers.where("c_mktsegment in ('BUILDING', 'MACHINERY')").select(
        F.col("c_custkey").alias("clave"), (F.col("c_acctbal") + 1).alias("saldo")
    )
    keyless = customers.where("c_mktsegment = 'HOUSEHOLD'").select(
        F.lit(None).cast("bigint").alias("clave"), F.col("c_acctbal").alias("saldo")
    )
    return target, changed.unionByName(keyless)


@query(ORACLES["upsert"])
def upsert_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table of the catalogue."""
    target, stage = _upserted(spark, sf_dir)
    name = "rosterflow_" + fresh_path(spark, "u").rsplit("-", 1)[1]
    history.rebuild_table(target, name, fresh_path(spark, "upsert"))
    return history.upsert_table(name, stage, ["clave"], fresh_path(spark, "upserted"))


_ORDERS_OF_1998_SQL = "archivo LIKE 'remesa_1998%'"


@query(f"""WITH {_ORDERS_SQL}, n AS (SELECT archivo, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM o GROUP BY archivo)
SELECT 'primera' AS carga, archivo, n AS filas, 0 AS filas_previas, 'inserción nueva' AS accion FROM n WHERE {_ORDERS_OF_1998_SQL}
UNION ALL SELECT 'segunda', archivo, n, n, 'reemplazo' FROM n WHERE {_ORDERS_OF_1998_SQL}
UNION ALL SELECT 'segunda', archivo, n, 0, 'inserción nueva' FROM n WHERE NOT {_ORDERS_OF_1998_SQL}
UNION ALL SELECT 'tercera', archivo, f, n, 'reemplazo' FROM n WHERE f > 0
UNION ALL SELECT 'queda', archivo, n, 0, '' FROM n""")
def history_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of three loads from the manifests, and the rows after the third one has been rolled back and old versions deleted."""
    table_ = History(spark, fresh_path(spark, "versions"), KEY)
    orders = _orders(spark, sf_dir)
    loads = {"primera": orders.where(F.col(KEY).startswith("remesa_1998")), "segunda": orders, "tercera": orders.where("o_orderstatus = 'F'")}
    told = [settle(table_.replace(rows).select(F.lit(name).alias("carga"), "*"), "summary") for name, rows in loads.items()]
    table_.rollback(2)
    table_.vacuum()
    left = table_.read().groupBy(KEY).agg(F.count("*").alias("filas"))
    told.append(left.select(F.lit("queda").alias("carga"), KEY, "filas", F.lit(0).cast("bigint").alias("filas_previas"), F.lit("").alias("accion")))
    return reduce(DataFrame.unionByName, told)


_KEYS_SQL = """k AS (SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN lpad(CAST(o_orderkey % 12 AS VARCHAR), 3, '0')
  WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'abc ' || (o_orderkey % 3) END AS archivo FROM orders)"""


@query(f"""WITH {_KEYS_SQL}, n AS (SELECT archivo, count(*) AS filas FROM k GROUP BY ALL)
SELECT k.archivo, o_orderkey, o_totalprice, filas, filas AS filas_previas, 'reemplazo' AS accion FROM k JOIN n USING (archivo)""")
def keys_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that look like numbers or dates (``007``, ``2025-01-01``) beside plain ones, loaded twice."""
    status = F.col("o_orderstatus")
    key = (
        F.when(status == "F", F.lpad((F.col("o_orderkey") % 12).cast("string"), 3, "0"))
        .when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.concat(F.lit("abc "), F.col("o_orderkey") % 3))
    )
    rows, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", key.alias(KEY)), fresh_path(spark, "keys")
    history.replace_partition(rows, path, KEY)
    # What the load replaces is counted before it is gone.
    summary = settle(history.load_summary(rows, KEY, history.read_history(spark, path)), "summary")
    history.replace_partition(rows, path, KEY)
    return history.read_history(spark, path).join(summary, KEY)


@query(f"""WITH {_ORDERS_SQL}, prior AS (SELECT archivo, count(*) AS n FROM o WHERE archivo < 'remesa_1998' GROUP BY archivo)
SELECT o.archivo, count(*) AS filas, coalesce(any_value(p.n), 0) AS filas_previas,
  CASE WHEN coalesce(any_value(p.n), 0) > 0 THEN 'reemplazo' ELSE 'inserción nueva' END AS accion
FROM o LEFT JOIN prior p USING (archivo) WHERE o.archivo >= 'remesa_1997' GROUP BY o.archivo""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return history.load_summary(orders.where(F.col(KEY) >= "remesa_1997"), KEY, orders.where(F.col(KEY) < "remesa_1998"))


@query("""
SELECT o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'abierta' ELSE 'cerrada' END AS estado, 'socio' AS socio,
  count(*) AS filas FROM orders GROUP BY ALL
UNION ALL SELECT 'TOTAL', 'TOTAL', 'socio', count(*) FROM orders""")
def rebuild_and_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived table rebuilt, its columns rewritten, and a second result inserted."""
    name = "rosterflow_" + fresh_path(spark, "t").rsplit("-", 1)[1]
    orders = table(spark, sf_dir, "orders")
    state = F.when(F.col("o_orderstatus") == "O", "abierta").otherwise("cerrada")
    detail = orders.withColumns({"estado": state, "socio": F.lit("socio")}).groupBy("o_orderstatus", "estado", "socio").agg(
        F.count("*").alias("filas")
    )
    path = fresh_path(spark, "rebuilt")
    history.rebuild_table(detail, name, path)
    history.rebuild_table(detail, name, path)
    totals = orders.agg(F.count("*").alias("filas")).select(
        F.lit("TOTAL").alias("o_orderstatus"), F.lit("TOTAL").alias("estado"), F.lit("socio").alias("socio"), "filas"
    )
    history.insert_select(totals, name)
    return spark.table(name)


@query("SELECT event_id, event_type FROM events WHERE NOT coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE value < 10 END, false)")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for which the predicate is unknown survive a delete."""
    unknown = F.when(F.col("event_type") != "view", F.col("value") < 10)
    return relational.delete_where(table(spark, sf_dir, "events"), unknown).select("event_id", "event_type")


# ------------------------------------------------------------------------ scans


@query("""
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS precio, strftime(o_orderdate, '%Y-%m-%d') AS fecha,
  CASE WHEN o_orderstatus = 'F' THEN 'Año ñandú' ELSE 'x;"y",' || chr(10) || 'z' END AS nota, o_orderstatus AS estado,
  carpeta
FROM orders JOIN (VALUES ('O', 'O 100%20'), ('P', 'P+1'), ('F', 'F [a]'), ('O', 'uno'), ('P', 'uno'), ('F', 'uno')) f(estado, carpeta) ON estado = o_orderstatus""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layouts (separator, encoding, header) with line breaks in cells, in folders whose names need escaping, read back without being told.

    A fourth folder has all rows in one file; files are read in ranges of 64 KB, whose borders lie in quoted cells as well.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("precio"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("fecha"),
        F.when(F.col("o_orderstatus") == "F", "Año ñandú").otherwise('x;"y",\nz').alias("nota"), F.col("o_orderstatus").alias("estado"),
    )
    path = fresh_path(spark, "csv")
    layouts = {
        "O 100%20": (";", "UTF-8", ["N° Operación", "Precio", "Fecha", "Nota", "Estado"]),
        "P+1": (",", "UTF-8", ["n operacion", "PRECIO", "fecha", "nota", "estado"]),
        "F [a]": ("\t", "ISO-8859-1", ["n_operacion", "precio", "fecha ", "nota", "ESTADO"]),
    }
    for folder, (sep, encoding, names) in layouts.items():
        orders.where(F.col("estado") == folder[0]).toDF(*names).write.option("header", True).option("sep", sep).option(
            "encoding", encoding
        ).option("escape", '"').csv(f"{path}/{folder}")
    orders.toDF(*layouts["P+1"][2]).coalesce(1).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(f"{path}/uno")
    read = csv.read_csv(spark, path, dates=["fecha"], numbers=["precio"], wholes=["n_operacion"], range_bytes=1 << 16)
    return read.select(
        F.col("n_operacion").alias("o_orderkey"), "precio", F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), "nota", "estado",
        F.element_at(F.split("_file", "/"), -2).alias("carpeta"),
    )


@query("""
WITH numbered AS (SELECT *, 'libro_' || (o_orderkey // 2000) || '.xlsx' AS libro FROM orders)
SELECT libro, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS fecha,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS prioridad, 'Base' AS hoja
FROM numbered""")
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed into workbooks by tasks and parsed back: sheet choice, shared texts, dates, blanks."""
    from rosterflow.queries.xlsx import pack_workbooks

    books = pack_workbooks(
        table(spark, sf_dir, "orders").select(
            F.concat(F.lit("libro_"), F.floor(F.col("o_orderkey") / 2000), F.lit(".xlsx")).alias("path"),
            "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("prioridad"),
        )
    )
    parsed = workbook.parse_workbooks(books, preferred=["  BASE "], fallback=0).where("_row > 0")
    cell = lambda i: F.get("cells", F.lit(i))
    return parsed.select(
        F.col("_file").alias("libro"), cell(0).cast("bigint").alias("o_orderkey"), cell(1).cast("double").alias("o_totalprice"),
        cell(2).alias("fecha"), cell(3).alias("prioridad"), F.col("_sheet").alias("hoja"),
    )


@query("""
SELECT o_orderkey, o_totalprice, 'Base' AS hoja, 'libro ' || (o_orderkey // 2000) || '.XLSX' AS libro
FROM orders WHERE o_orderkey // 2000 = (SELECT max(o_orderkey // 2000) FROM orders)""")
def newest_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a folder of workbooks with two sheets, the newest one's preferred sheet; a newer file of another kind does not count."""
    from rosterflow.queries.xlsx import pack_workbooks, write_files

    folder, number = fresh_path(spark, "books"), F.floor(F.col("o_orderkey") / 2000)
    orders = table(spark, sf_dir, "orders").select(
        number.alias("n"), "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("prioridad")
    )
    last = orders.agg(F.max("n")).first()[0]
    named = orders.withColumn("path", F.concat(F.lit(f"{folder}/libro "), "n", F.lit(".XLSX")))
    other = orders.where(F.col("n") == 0).withColumn("path", F.lit(f"{folder}/libro {last + 1}.bak"))
    # Written in any order: their times follow their numbers.
    write_files(pack_workbooks(named.unionByName(other).drop("n"))).write.format("noop").mode("overwrite").save()
    fs, place = history._filesystem(spark, folder)
    for status in fs.listStatus(place):
        n = int(status.getPath().getName().split(" ")[1].split(".")[0])
        fs.setTimes(status.getPath(), (1_700_000_000 + n) * 1000, -1)
    newest = workbook.read_latest_workbook(spark, folder, ("xlsx",), preferred=["otra", " BASE "]).where("_row > 0")
    cell = lambda i: F.get("cells", F.lit(i))
    return newest.select(
        cell(0).cast("bigint").alias("o_orderkey"), cell(1).cast("double").alias("o_totalprice"), F.col("_sheet").alias("hoja"),
        F.element_at(F.split("_file", "/"), -1).alias("libro"),
    )


@query(f"""
SELECT n_name, count(*) AS clientes, {cents_sql("sum(c_acctbal)")} AS saldo
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.query(
        spark,
        "SELECT n_name, count(*) AS clientes, sum(c_acctbal) AS saldo FROM {customer} JOIN {nation} "
        "ON c_nationkey = n_nationkey GROUP BY n_name",
        customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"),
    )
    return found.withColumn("saldo", cents(F.col("saldo")))


@query(f"""WITH {_ORDERS_SQL} SELECT archivo, o_orderkey, o_totalprice FROM o""")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders file arrives in a folder stream; a second run finds nothing new."""
    path, checkpoint = fresh_path(spark, "landed"), fresh_path(spark, "checkpoint")
    schema = table(spark, sf_dir, "orders").schema

    def prepare(batch: DataFrame) -> DataFrame:
        return batch.select(
            F.date_format("o_orderdate", "'remesa_'yyyyMM'.csv'").alias(KEY), "o_orderkey", "o_totalprice"
        )

    for _ in range(2):
        land_and_wait(
            spark, sf_dir, path, KEY, prepare, schema=schema, checkpoint=checkpoint, pathGlobFilter="orders.parquet"
        )
    return History(spark, path, KEY).read().select(KEY, "o_orderkey", "o_totalprice")


@query("""
SELECT o_orderstatus AS archivo, o_orderkey, o_totalprice * 2 AS o_totalprice, lote
FROM orders, (VALUES ('uno'), ('muchos')) l(lote) WHERE o_orderkey % 2 = 0""")
def stream_newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key sent in two files keeps the newer one, whether they come one by one or together."""
    folder, orders = fresh_path(spark, "sent"), table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias(KEY), "o_orderkey", "o_totalprice"
    )
    orders.coalesce(1).write.parquet(folder)
    again = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    again.coalesce(1).write.mode("append").parquet(folder)
    found = []
    for name, files in (("uno", 1), ("muchos", 10)):
        path = fresh_path(spark, "newest")
        land_and_wait(
            spark, folder, path, KEY, lambda batch: batch, schema=orders.schema, checkpoint=fresh_path(spark, "newest-checkpoint"),
            files_per_batch=files,
        )
        found.append(History(spark, path, KEY).read().select(KEY, "o_orderkey", "o_totalprice", F.lit(name).alias("lote")))
    return found[0].unionByName(found[1])


def _sent_at(spark: SparkSession, rows: DataFrame, folder: str, days_ago: int) -> None:
    """One more file in ``folder``, changed so many days ago."""
    part = f"{folder}/{days_ago}"
    rows.coalesce(1).write.parquet(part)
    fs, place = history._filesystem(spark, part)
    then = spark._jvm.java.lang.System.currentTimeMillis() - days_ago * 86_400_000
    for status in fs.listStatus(place):
        fs.setTimes(status.getPath(), then, -1)


@query("""
SELECT o_orderstatus AS archivo, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'nuevo' WHEN 'O' THEN 'corrige' ELSE 'tarde' END AS envio, corrida
FROM orders, (VALUES ('tercera'), ('repetida')) c(corrida)
UNION ALL SELECT o_orderstatus, o_orderkey, 'nuevo', 'primera' FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderstatus, o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'tarde' ELSE 'nuevo' END, 'segunda' FROM orders""")
def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive late, over four runs of one stream.

    The first file has two keys.  A second one, twenty days older, has one of them
    (ignored) and a new one (loaded); a third one is newer and corrects a key; the
    last run finds nothing.
    """
    folder, path, checkpoint = (fresh_path(spark, x) for x in ("late", "landed", "late-checkpoint"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias(KEY), "o_orderkey")
    stored, found = History(spark, path, KEY), []
    sent = [
        ("primera", 10, orders.where(F.col(KEY) != "P").withColumn("envio", F.lit("nuevo"))),
        ("segunda", 30, orders.where(F.col(KEY) != "O").withColumn("envio", F.lit("tarde"))),
        ("tercera", 5, orders.where(F.col(KEY) == "O").withColumn("envio", F.lit("corrige"))),
        ("repetida", 0, None),
    ]
    for run, days_ago, rows in sent:
        if rows is not None:
            _sent_at(spark, rows, folder, days_ago)
        land_and_wait(
            spark, folder, path, KEY, lambda batch: batch, schema="archivo string, o_orderkey long, envio string", checkpoint=checkpoint,
            recursiveFileLookup="true",
        )
        found.append(stored.read().withColumn("corrida", F.lit(run)))
    return reduce(DataFrame.unionByName, found)


@query("SELECT 'SELECT' AS orden, true AS bien UNION ALL SELECT 'RAISE', false")
def timed_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement is run to its end: one that fails only on its rows is reported as failed."""
    name = "rosterflow_orders"
    table(spark, sf_dir, "orders").createOrReplaceTempView(name)
    done = {
        "SELECT": export.run_statement(spark, f"SELECT sum(o_totalprice) FROM {name}"),
        "RAISE": export.run_statement(spark, f"SELECT raise_error('x') FROM {name}"),
    }
    return spark.createDataFrame([(k, v["ok"]) for k, v in done.items()], "orden string, bien boolean")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def export_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a preview shows, exported as CSV and read back."""
    path = fresh_path(spark, "export")
    shown = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_orderpriority")
    export.export_shown(shown, path, "csv", 25)
    return spark.read.option("header", True).csv(path)


# ---------------------------------------------------------------------- quality


@query("""
SELECT 'user_id' AS columna, count(*) FILTER (WHERE value < 1) AS nulos FROM events
UNION ALL SELECT 'event_type', 0 UNION ALL SELECT 'value', count(*) FILTER (WHERE event_type = 'view') FROM events""")
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("value") >= 1, F.col("user_id")).alias("user_id"), "event_type",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )
    return quality.null_report(events, ["user_id", "event_type", "no_existe", "value"])


@query("""
SELECT 'l_quantity' AS columna, 0::BIGINT AS con_decimales
UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE l_extendedprice <> round_even(l_extendedprice, 0)) FROM lineitem""")
def fraction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fraction_report(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


@query("""
SELECT 'fecha' AS columna, count(*) AS filas, count(*) FILTER (WHERE o_orderstatus <> 'P') AS con_valor,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS convertidas, count(*) FILTER (WHERE o_orderstatus = 'O') AS fallidas FROM orders""")
def conversion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rosterflow.functions.dates import text_date

    dated = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(F.col("o_orderstatus") == "O", "sin dato").otherwise(" ").alias("fecha")
    )
    return quality.conversion_report(dated, [("fecha", text_date(F.col("fecha")))])


@query("SELECT CASE WHEN event_type <> 'view' THEN event_type END AS event_type, count(*) AS filas FROM events GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")
    return quality.value_counts(table(spark, sf_dir, "events").select(shown), "event_type")


@query(f"WITH {_ORDERS_SQL} SELECT DISTINCT archivo FROM o ORDER BY archivo DESC")
def distinct_keys_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.distinct_descending(_orders(spark, sf_dir), KEY)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return relational.top_rows(orders, 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(f"WITH {_ORDERS_SQL} SELECT archivo, o_orderkey FROM o WHERE archivo IN ('remesa_199803.csv', 'remesa_200002.csv')")
def rows_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.rows_of(_orders(spark, sf_dir), KEY, "remesa_199803.csv", "remesa_200002.csv").select(KEY, "o_orderkey")


@query("""
SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segmento, count(*) AS filas FROM customer
WHERE c_mktsegment <> 'BUILDING' GROUP BY 1""")
def rows_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segmento")
    return quality.rows_per_key(table(spark, sf_dir, "customer").select(key), "segmento")


@query("SELECT DISTINCT c_mktsegment AS segmento FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def valid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.expr("case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then '  ' else concat(c_mktsegment, ' ') end")
    return quality.valid_keys(table(spark, sf_dir, "customer").select(key.alias("segmento")), "segmento")


@query("""
SELECT count(*) FILTER (WHERE p_brand <> '') AS marca, count(*) AS nombre FROM part""")
def changed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rosterflow.functions.identity import digits_only

    parts = table(spark, sf_dir, "part")
    return quality.changed_count(parts, [
        (F.col("p_brand"), digits_only(F.col("p_brand")), "marca"), (F.col("p_name"), digits_only(F.col("p_name")), "nombre"),
    ])


@query("""
SELECT * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
  ('c_mktsegment', 'string')) v(columna, tipo), (SELECT count(*) AS filas FROM customer)""")
def preview_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, shape = quality.preview(table(spark, sf_dir, "customer"))
    return shape


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a preview, which holds the whole of a table this small."""
    rows, _ = quality.preview(table(spark, sf_dir, "nation"), 25)
    return rows


@query("""
SELECT o_orderkey, o_custkey, NULL AS extra FROM orders UNION ALL SELECT c_custkey, NULL, c_name FROM customer""")
def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different columns stacked by name."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.col("c_name").alias("extra"))
    return orders.unionByName(customers, allowMissingColumns=True)
