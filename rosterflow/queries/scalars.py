"""Text, period, number, date and identifier functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions import dates, identity, numbers, periods, text
from rosterflow.operators import relational
from rosterflow.queries.registry import cents, cents_sql, query, table
from rosterflow.sources.contracts import POLICY_PLANS

@query("""
SELECT doc_id,
  md5(trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', '_', 'g'), '_')) AS name_md5,
  md5(strip_accents(replace(text, chr(160), ' '))) AS folded_md5
FROM documents""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.md5(text.normalize_name(F.col("text"))).alias("name_md5"),
        F.md5(text.strip_accents(F.col("text"))).alias("folded_md5"),
    )


@query("""
SELECT doc_id, md5(strip_accents(replace(text, chr(160), ' '))) AS folded_md5 FROM documents""")
def strip_accents_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.strip_accents_unicode(F.col("text"))).alias("folded_md5"))


@query("""
WITH cells AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN ' None ' WHEN 'MACHINERY' THEN 'nan'
    WHEN 'FURNITURE' THEN NULL WHEN 'HOUSEHOLD' THEN '   ' ELSE '  "' || c_name || '" ' END AS raw FROM customer)
SELECT c_custkey,
  CASE WHEN raw IS NULL OR trim(raw) IN ('None', 'none', 'nan', 'NaN') THEN '' ELSE trim(raw) END AS cleaned,
  trim(trim(raw), '"') AS unquoted, substr(trim(raw), 1, 10) AS limited,
  (raw IS NULL OR lower(trim(raw)) IN ('', 'none', 'nan')) AS nullish, raw AS readable
FROM cells""")
def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "case c_mktsegment when 'BUILDING' then ' None ' when 'MACHINERY' then 'nan' when 'FURNITURE' then null "
        "when 'HOUSEHOLD' then '   ' else concat('  \"', c_name, '\" ') end"
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.clean_cell(raw).alias("cleaned"), text.strip_quotes(raw).alias("unquoted"),
        text.limit_text(raw, 10).alias("limited"), text.is_nullish(raw).alias("nullish"),
        text.readable_text(raw.cast("binary")).alias("readable"),
    )


# ---------------------------------------------------------------------- periods

_MONTH_WORDS = ["Enero", "FEB", "marzo", "Abr", "MAYO", "Jun", "Julio", "AGO", "Setiembre", "Oct", "Noviembre", "Dic"]
_MONTHS = str(_MONTH_WORDS)
_NAMES_SQL = f"""names AS (
  SELECT o_orderkey, year(o_orderdate) + 10 AS y, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS m,
    o_orderdate, {_MONTHS}[month(o_orderdate)] AS w,
    CAST((year(o_orderdate) + 10) * 100 + month(o_orderdate) AS VARCHAR) AS p, o_orderpriority AS kind
  FROM orders),
named AS (
  SELECT *, CASE kind WHEN '1-URGENT' THEN 'Base ' || y || m || '.xlsx' WHEN '2-HIGH' THEN 'Base ' || y || '-' || m || '.xlsx'
    WHEN '3-MEDIUM' THEN 'Base ' || m || '_' || y || '.xlsx' WHEN '4-NOT SPECIFIED' THEN 'Base Stock ' || w || ' ' || y || '.xlsx'
    ELSE 'Base sin dato.xlsx' END AS file_name
  FROM names)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in _MONTH_WORDS])
    base = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.year("o_orderdate") + 10).alias("y"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("m"),
        "o_orderdate",
        F.element_at(words, F.month("o_orderdate")).alias("w"), F.col("o_orderpriority").alias("kind"),
    )
    return base.withColumn("file_name", F.expr(
        "case kind when '1-URGENT' then concat('Base ', y, m, '.xlsx') when '2-HIGH' then concat('Base ', y, '-', m, '.xlsx') "
        "when '3-MEDIUM' then concat('Base ', m, '_', y, '.xlsx') "
        "when '4-NOT SPECIFIED' then concat('Base Stock ', w, ' ', y, '.xlsx') else 'Base sin dato.xlsx' end"
    ))


@query(f"""WITH {_NAMES_SQL}
SELECT o_orderkey, CASE WHEN kind <> '5-LOW' THEN p END AS period, CASE WHEN kind = '1-URGENT' THEN p END AS plain,
  CASE WHEN kind <> '5-LOW' THEN p END AS with_extra_words
FROM named""")
def period_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("file_name")
    return _names(spark, sf_dir).select(
        "o_orderkey", periods.period_from_name(name).alias("period"), periods.plain_period(name).alias("plain"),
        periods.period_from_name(name, extra_words=True).alias("with_extra_words"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 120 MONTH, '%Y%m') AS period FROM orders""")
def period_from_short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviated months with a dot, ``SEPT.`` among them."""
    words = F.array(*[F.lit(w) for w in ("ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEPT", "OCT", "NOV", "DIC")])
    day = F.add_months(F.col("o_orderdate").cast("date"), 120)
    name = F.concat(F.lit("Vida "), F.element_at(words, F.month(day)), F.lit(". "), F.year(day), F.lit(".xlsx"))
    return table(spark, sf_dir, "orders").select("o_orderkey", periods.period_from_name(name, extra_words=True).alias("period"))


@query(f"""WITH {_NAMES_SQL}, known AS (SELECT *, CASE WHEN kind <> '5-LOW' THEN p END AS q FROM named)
SELECT o_orderkey, 'Facturacion_Cesantia_' || q || '.xlsx' AS planes, q || ' Cesantia Plus.xlsx' AS colmena,
  'UNIDAD LEASING - Cesantia - ' || coalesce(q, '000000') || '.xlsx' AS unidad_leasing,
  CASE kind WHEN '4-NOT SPECIFIED' THEN 'Base Stock ' || p || '.xlsx' ELSE file_name END AS in_place
FROM known""")
def canonical_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = periods.period_from_name(F.col("file_name"))
    return _names(spark, sf_dir).select(
        "o_orderkey",
        *[periods.canonical_name(period, s).alias(s) for s in ("planes", "colmena", "unidad_leasing")],
        periods.canonical_in_place(F.col("file_name")).alias("in_place"),
    )


@query(f"""WITH {_NAMES_SQL}
SELECT o_orderkey, lpad(CAST(o_orderkey % 10000000 AS VARCHAR), 7, '0') AS policy, p AS folder_period,
  p AS trailing, CAST(p AS INTEGER) AS valid,
  'remesa_' || strftime(CAST(o_orderdate - INTERVAL 1 MONTH AS DATE), '%Y%m') || '.csv' AS remittance
FROM named""")
def file_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad((F.col("o_orderkey") % 10000000).cast("string"), 7, "0")
    in_folder = F.concat(F.lit("data/"), "y", "m", F.lit("/Nomina "), number, F.lit(".xlsx"))
    dated = F.concat(F.lit("Facturacion "), "y", "m", F.lit(".xlsx"))
    return _names(spark, sf_dir).select(
        "o_orderkey", periods.policy_from_name(in_folder).alias("policy"),
        periods.plain_period(F.element_at(F.split(in_folder, "/"), -2)).alias("folder_period"),
        periods.trailing_period(dated).alias("trailing"), periods.valid_period(periods.trailing_period(dated)).alias("valid"),
        periods.remittance_name(F.concat(F.lit("remesa_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv"))).alias("remittance"),
    )


@query("""
SELECT o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) AS period,
  CAST(strftime(CAST(o_orderdate - INTERVAL 1 MONTH AS DATE), '%Y%m') AS INTEGER) AS prior
FROM orders""")
def prior_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = periods.period_of(F.year("o_orderdate"), F.month("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", period.alias("period"), periods.prior_period(period).alias("prior")
    )


# ---------------------------------------------------------------------- numbers

_CL = "replace(replace(replace(format('{:,.2f}', o_totalprice), ',', '#'), '.', ','), '#', '.')"


@query(f"""WITH texts AS (
  SELECT o_orderkey, o_totalprice AS x, {_CL} AS cl, CASE o_orderstatus WHEN 'P' THEN 'abc' WHEN 'F' THEN ' ' || o_totalprice || ' '
    ELSE 'NaN' END AS mixed
  FROM orders)
SELECT o_orderkey, cl, x AS local_number, x AS guessed, CASE WHEN mixed LIKE ' %' THEN x END AS coerced,
  CASE WHEN mixed LIKE ' %' THEN CAST(trunc(x) AS BIGINT) END AS truncated
FROM texts""")
def cl_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    cl = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    mixed = F.expr(
        "case o_orderstatus when 'P' then 'abc' when 'F' then concat(' ', o_totalprice, ' ') else 'NaN' end"
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", cl.alias("cl"), numbers.local_number(cl).alias("local_number"),
        numbers.guessed_local_number(cl).alias("guessed"), numbers.to_number(mixed).alias("coerced"),
        numbers.truncated_whole(mixed).alias("truncated"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 2 AS half,
  CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS rounded,
  CASE WHEN l_quantity / 2 = floor(l_quantity / 2) THEN CAST(l_quantity / 2 AS BIGINT) END AS exact,
  printf('%.2f', l_extendedprice / 8) AS two_decimals
FROM lineitem""")
def int_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    shown = half.cast("string")
    eighth = F.replace((F.col("l_extendedprice") / 8).cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", half.alias("half"),
        numbers.to_whole(shown, "round").alias("rounded"), numbers.to_whole(shown, "null").alias("exact"),
        numbers.fixed_text(eighth).alias("two_decimals"),
    )


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {cents_sql('l_extendedprice / 1.19::DOUBLE', 4)} AS net_of_vat,
  {cents_sql('''CASE WHEN p_size = 10 THEN l_extendedprice * 3 WHEN p_size = 20 THEN l_extendedprice * 6
    WHEN p_size = 30 THEN l_extendedprice * 8 WHEN p_size = 40 THEN l_extendedprice * 12 ELSE l_extendedprice * 4 END''')} AS insured,
  {cents_sql('''CASE WHEN p_size = 15 THEN 0.0476::DOUBLE * l_extendedprice WHEN p_size IN (10, 20, 30, 40, 45) THEN 0.0874::DOUBLE * l_extendedprice
    WHEN p_size = 25 THEN 0.0665::DOUBLE * l_extendedprice WHEN p_size IN (35, 50) THEN 0.0087::DOUBLE * l_extendedprice ELSE 0.0 END''', 4)} AS commission,
  {cents_sql('l_extendedprice / nullif(l_discount, 0)', 4)} AS in_units
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def money_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size classes stand for the technical plans."""
    plans = {10: 4331, 20: 4332, 30: 4333, 40: 4334, 45: 4422, 15: 4277, 25: 6270, 35: 6832, 50: 8285}
    case = F.create_map(*[F.lit(x) for pair in plans.items() for x in pair])
    plan = F.coalesce(F.element_at(case, F.col("p_size")), F.lit(0))
    price = F.col("l_extendedprice")
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents(numbers.net_of_vat(price), 4).alias("net_of_vat"),
        cents(numbers.insured_amount(plan, price)).alias("insured"),
        cents(numbers.commission(plan, price), 4).alias("commission"),
        cents(numbers.in_units(price, F.col("l_discount")), 4).alias("in_units"),
    )


# ------------------------------------------------------------------------ dates

_SERIAL = "datediff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE))"
_YMD = "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST({_YMD} AS BIGINT) END AS mixed,
  o_orderpriority = '5-LOW' AS failed,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS listed,
  CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(CAST(o_orderdate AS DATE), '%d%m%Y')
    WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END AS compact,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST({_YMD} AS BIGINT) END AS strict
FROM orders""")
def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout per priority: d/m/Y, YYYYMMDD, full timestamp, serial with fraction, no date."""
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date"))
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(serial, F.lit(".25")))
        .otherwise("sin fecha")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", dates.as_int(dates.mixed_date(F.col("raw"))).alias("mixed"),
        dates.mixed_date_failed(F.col("raw")).alias("failed"),
        F.date_format(dates.listed_date(F.col("raw")), "yyyy-MM-dd").alias("listed"),
        dates.compact_text(F.col("raw")).alias("compact"), dates.strict_timestamp_number(F.col("raw")).alias("strict"),
    )


@query(f"""
SELECT o_orderkey, CAST({_SERIAL} AS BIGINT) AS serial, CAST({_YMD} AS BIGINT) AS serial_day, CAST({_YMD} AS BIGINT) AS number_day,
  CAST(strftime(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1462 DAY AS DATE), '%Y%m%d') AS BIGINT) AS other_calendar,
  CAST(strftime(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE), '%Y%m%d') AS BIGINT) AS next_day
FROM orders""")
def excel_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit(dates.CALENDAR_1900).cast("date")).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", serial.alias("serial"), dates.as_int(dates.serial_date(serial)).alias("serial_day"),
        dates.date_number(F.concat(serial.cast("string"), F.lit(".75"))).alias("number_day"),
        dates.as_int(dates.mixed_date(serial, base=dates.CALENDAR_1904)).alias("other_calendar"),
        dates.as_int(dates.next_day(day)).alias("next_day"),
    )


@query("""
WITH moved AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
  CASE o_orderstatus WHEN 'P' THEN CAST(o_orderdate - INTERVAL 300 YEAR AS DATE) ELSE CAST(o_orderdate AS DATE) END AS moved FROM orders)
SELECT o_orderkey, CASE WHEN moved BETWEEN DATE '1753-01-01' AND DATE '9999-12-31' THEN strftime(moved, '%Y-%m-%d') END AS clamped,
  strftime(day, '%Y-%m-%d') AS day_first,
  CASE WHEN day(day) <= 12 THEN strftime(make_date(year(day), day(day), month(day)), '%Y-%m-%d') ELSE strftime(day, '%Y-%m-%d') END AS month_first
FROM moved""")
def date_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    moved = F.when(F.col("o_orderstatus") == "P", F.add_months(day, -3600)).otherwise(day)
    written = F.date_format(day, "d/M/yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(dates.clamp_date(moved), "yyyy-MM-dd").alias("clamped"),
        F.date_format(dates.text_date(written, dayfirst=True), "yyyy-MM-dd").alias("day_first"),
        F.date_format(dates.text_date(written), "yyyy-MM-dd").alias("month_first"),
    )


# ------------------------------------------------------------------ identifiers

_RUT_SQL = """ids AS (
  SELECT c_custkey, CAST(c_custkey + 900000 AS VARCHAR) AS n,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'k' ELSE CAST(c_nationkey % 10 AS VARCHAR) END AS dv,
    regexp_replace(CAST(c_custkey + 900000 AS VARCHAR), '(\\d{3})$', '.\\1') AS dotted, c_mktsegment FROM customer)"""


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = (F.col("c_custkey") + 900000).cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", number.alias("n"),
        F.when(F.col("c_mktsegment") == "BUILDING", "k").otherwise((F.col("c_nationkey") % 10).cast("string")).alias("dv"),
        F.regexp_replace(number, r"(\d{3})$", r".$1").alias("dotted"),
    )


@query(f"""WITH {_RUT_SQL}
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN n END AS number, CASE WHEN c_mktsegment <> 'MACHINERY' THEN upper(dv) END AS digit
FROM ids""")
def rut_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("c_mktsegment") == "MACHINERY", "/").otherwise("-")
    written = F.concat(F.lit(" "), "dotted", mark, "dv")
    return _ids(spark, sf_dir).select(
        "c_custkey", identity.hyphen_number(written).alias("number"), identity.hyphen_digit(written).alias("digit")
    )


@query(f"""WITH {_RUT_SQL}
SELECT c_custkey, CAST(n AS BIGINT) AS number, upper(dv) AS digit, n || CASE WHEN dv = 'k' THEN '' ELSE dv END AS digits FROM ids""")
def rut_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat("dotted", F.lit(" - "), "dv")
    return _ids(spark, sf_dir).select(
        "c_custkey", identity.joined_number(written).alias("number"), identity.joined_digit(written).alias("digit"),
        identity.digits_only(written).alias("digits"),
    )


@query(f"""WITH {_RUT_SQL}
SELECT c_mktsegment, count(*) AS filas, count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD') AS validos FROM ids GROUP BY c_mktsegment""")
def rut_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat("n", F.lit("000"))).otherwise(F.col("dotted"))
    return _ids(spark, sf_dir).groupBy("c_mktsegment").agg(
        F.count("*").alias("filas"), F.count_if(identity.has_valid_shape(written)).alias("validos")
    )


@query(f"""WITH {_RUT_SQL}
SELECT c_custkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN upper(dv) END AS dv FROM ids""")
def dv_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("c_mktsegment") == "FURNITURE", "  ").otherwise(F.concat(F.lit(" "), "dv", F.lit("x ")))
    return _ids(spark, sf_dir).select("c_custkey", identity.check_digit(written).alias("dv"))


# ---------------------------------------------------------------------- lookups

_POLICIES = "['" + "','".join(POLICY_PLANS) + "']"
_MAPPED_SQL = f"""mapped AS (
  SELECT p_partkey, {_POLICIES}[(p_size + 4) // 5] AS policy, [{', '.join(map(str, POLICY_PLANS.values()))}][(p_size + 4) // 5] AS plan
  FROM part)"""


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten size classes; only the first eight have a policy of the configured table."""
    known = F.array(*[F.lit(p) for p in POLICY_PLANS])
    policy = F.get(known, F.floor((F.col("p_size") - 1) / 5).cast("int"))
    unknown = F.concat(F.lit("otra "), F.col("p_brand"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.coalesce(policy, unknown).alias("policy"))
    return relational.map_lookup(parts, "policy", "plan", POLICY_PLANS)


@query(f"""WITH {_MAPPED_SQL}
SELECT CAST(plan AS BIGINT) AS plan, count(*) AS filas FROM mapped GROUP BY plan""")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir).groupBy("plan").agg(F.count("*").alias("filas"))


@query("SELECT DISTINCT 'otra ' || p_brand AS policy FROM part WHERE p_size > 40")
def unmapped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.unmapped_keys(_mapped(spark, sf_dir), "policy", "plan")
