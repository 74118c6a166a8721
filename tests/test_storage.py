"""Sinks, scans and the incremental load, each in a fresh folder."""

import csv as parser
import io
import os
import random
import time
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterflow.queries.xlsx import write_workbook
from rosterflow.sinks import export, history
from rosterflow.sinks.versioned import History
from rosterflow.sources import csv, files, tables, workbook
from rosterflow.streaming.landing import land_and_wait, newer_rows


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_is_idempotent_and_skips_blank_keys(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([("a b.xlsx", 1), ("a b.xlsx", 2), ("c.xlsx", 3), (None, 4), (" ", 5)], "k string, v int")
    assert history.unloaded_rows(df, "k") == 2
    for _ in range(2):
        history.replace_partition(df, path, "k")
    got = history.read_history(spark, path).select("k", "v")
    assert _rows(got) == [("a b.xlsx", 1), ("a b.xlsx", 2), ("c.xlsx", 3)]
    history.replace_partition(spark.createDataFrame([("c.xlsx", 9)], "k string, v int"), path, "k")
    assert _rows(history.read_history(spark, path).select("k", "v")) == [("a b.xlsx", 1), ("a b.xlsx", 2), ("c.xlsx", 9)]


def test_listed_values_are_dropped_even_when_absent(spark, tmp_path):
    path = str(tmp_path / "h")
    history.append(spark.createDataFrame([("a:1 x", 1), ("b", 2)], "k string, v int"), path, "k")
    history.replace_partition(spark.createDataFrame([("b", 7)], "k string, v int"), path, "k", ["a:1 x", "zz"])
    assert _rows(history.read_history(spark, path).select("k", "v")) == [("b", 2), ("b", 7)]


def test_load_summary(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert _rows(history.load_summary(df, "k", df.where("k = 'b'"))) == [("a", 2, 0, "inserción nueva"), ("b", 1, 1, "reemplazo")]
    assert _rows(history.load_summary(df, "k", None))[0] == ("a", 2, 0, "inserción nueva")


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, w string")
    stage = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    merged = history.upsert(target, stage, ["k"]).select("k", "v", "w")
    assert _rows(merged) == sorted([(1, "a", "x"), (2, "B", "y"), (None, "n", "z"), (3, "C", None), (None, "N", None)], key=repr)
    with pytest.raises(ValueError):
        history.upsert(target, stage.unionByName(stage.where("k = 2")), ["k"])


def test_upsert_of_keys_only_inserts(spark):
    target = spark.createDataFrame([(1,), (2,)], "k int")
    assert _rows(history.upsert(target, spark.createDataFrame([(2,), (3,)], "k int"), ["k"])) == [(1,), (2,), (3,)]


def test_export_and_statement(spark, tmp_path):
    df = spark.createDataFrame([(i, b"\xff") for i in range(5)], "i int, b binary")
    export.export_shown(df, str(tmp_path / "p"), "parquet", 3)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    export.export_shown(df, str(tmp_path / "c"), "csv", 2)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert export.run_statement(spark, "SELECT 1")["ok"] is True
    failed = export.run_statement(spark, "SELECT nope")
    assert failed["ok"] is False and "nope" in failed["error"]


# ------------------------------------------------------------------------ files


def _touch(path, seconds):
    path.write_bytes(b"x")
    os.utime(path, (seconds, seconds))


def test_latest_file(spark, tmp_path):
    now = time.time()
    _touch(tmp_path / "old.xlsx", now - 50)
    _touch(tmp_path / "new.XLSX", now - 10)
    _touch(tmp_path / "newest.csv", now)
    (tmp_path / "sub").mkdir()
    _touch(tmp_path / "sub" / "deep.xlsx", now - 1)
    assert files.latest_file(spark, str(tmp_path), ["xlsx"]).endswith("/new.XLSX")
    assert files.latest_file(spark, str(tmp_path), [".xlsx"], recursive=True).endswith("/sub/deep.xlsx")
    with pytest.raises(FileNotFoundError):
        files.latest_file(spark, str(tmp_path), [".parquet"])


def test_sheet_choice():
    assert workbook.choose_sheet(["a", " Base  Flujo "], ["base flujo"], 0) == 1
    assert workbook.choose_sheet(["a", "b"], ["z"], 1) == 1


def test_workbooks(spark, tmp_path):
    from datetime import date

    body = {0: ["N°", "Día", "Monto", "Ok"], 2: [12, date(2025, 9, 5), 10.0, True], 3: ["a&b", None, 0.1, None, "N/A"]}
    (tmp_path / "uno.xlsx").write_bytes(write_workbook({"Otra": {0: ["z"]}, "Base Flujo": body}))
    (tmp_path / "dos.XLSX").write_bytes(write_workbook({"Sola": {0: ["h"], 1: ["v"]}}))
    (tmp_path / "notas.txt").write_text("x")
    got = workbook.read_workbooks(spark, str(tmp_path), preferred=["base flujo"])
    uno = got.where(F.col("_file").endswith("uno.xlsx")).orderBy("_row").collect()
    assert [(r["_row"], r["cells"]) for r in uno] == [
        (0, ["N°", "Día", "Monto", "Ok"]), (1, []), (2, ["12", "2025-09-05 00:00:00", "10", "True"]), (3, ["a&b", None, "0.1"])]
    assert got.where("_sheet = 'Sola'").count() == 2
    os.utime(tmp_path / "uno.xlsx", (1, 1))
    assert workbook.read_latest_workbook(spark, str(tmp_path), ("xlsx",)).select("_sheet").distinct().first()[0] == "Sola"


def test_csv_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿"Nº Operación";Fecha De Pago;Año\n1;05/09/2025;"x;y"\n\n2;;\n'.encode())
    (tmp_path / "b.csv").write_bytes("n operacion,fecha de pago,AÑO\n3,06/09/2025,ñandú\n".encode("latin1"))
    (tmp_path / "c.csv").write_bytes(b"no_operacion\tano\n4\tz\n")
    df = csv.read_csv(spark, str(tmp_path), dates=["fecha_de_pago"])
    assert {c for c in df.columns if not c.startswith("_")} == {"no_operacion", "n_operacion", "fecha_de_pago", "ano"}
    rows = {(r["no_operacion"] or r["n_operacion"]): (str(r["fecha_de_pago"]), r["ano"]) for r in df.collect()}
    assert rows == {"1": ("2025-09-05", "x;y"), "2": ("None", ""), "3": ("2025-09-06", "ñandú"), "4": ("None", "z")}
    first = df.where(F.col("_file").endswith("a.csv")).orderBy("_row").first()
    assert first["no_operacion"] == "1"


def _plain_csv(content):
    """(row, cells, extra) of a file, parsed as a whole."""
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = content.decode("ISO-8859-1")
    text = text.lstrip("\r\n")
    separator = ";,\t"[csv.choose_separator(text.split("\n", 1)[0].rstrip("\r"), ";,\t")]
    header, *rows = parser.reader(io.StringIO(text, newline=""), delimiter=separator)
    rows = [r for r in rows if r]
    return [csv.cut(i, r, len(header), False) for i, r in enumerate(rows, 1)]


def _messy(draw, rows):
    """A file with quoted breaks, doubled and stray quotes, blank lines, long rows and lone carriage returns."""
    sep, end = draw.choice([";", ",", "\t"]), draw.choice(["\n", "\r\n"])
    cells = ["", "a", "b c", '"x\ny"', '"x\r\ny"', '"q ""z"""', 'st"ray', '"a"b', '"' + "long\n" * 9 + '"', "ñ", f'"{sep}"', '"', "l\ro"]
    weights = [9, 30, 20, 6, 3, 6, 3, 2, 2, 5, 4, draw.choice([0, 0.2]), 1]
    lines = [sep.join(["h1", '"h\n2"', "h3"])]
    for _ in range(rows):
        lines.append("" if draw.random() < 0.03 else sep.join(draw.choices(cells, weights, k=draw.choice([3, 3, 3, 2, 4]))))
    return (draw.choice(["", end, "\ufeff"]) + end.join(lines) + draw.choice(["", end])).encode()


@pytest.mark.parametrize("size", [61, 257, 4096, None])
def test_csv_ranges_parse_as_whole_files(spark, tmp_path, size):
    """Ranges of any size, shorter than a record included, give the rows of the whole file."""
    draw, want = random.Random(size or 1), {}
    for i in range(12):
        content = _messy(draw, 200) if i else b"a;b\n1;\xf1\n2;3;9\n"
        (tmp_path / f"{i}.csv").write_bytes(content)
        want[f"{i}.csv"] = _plain_csv(content)
    (tmp_path / "blank.csv").write_bytes(b"\n\r\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_bytes(b"a;b")
    got = {}
    for r in csv.scan_csv(spark, str(tmp_path), range_bytes=size).collect():
        got.setdefault(r["_file"].rsplit("/", 1)[1], []).append((r["_row"], r["cells"], r["extra"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_states_of_a_line():
    assert csv.after_line("a;b", ";", 0) == (0, 1) and csv.after_line("a;b", ";", 1) == (1, 0)
    assert csv.after_line('a;"b', ";", 0) == (1, 1) and csv.after_line('a;"b', ";", 1) == (0, 0)
    assert csv.after_line('c";d', ";", 1) == (0, 0) and csv.after_line('c"";d', ";", 1) == (1, 0)
    assert csv.after_line('c";"d', ";", 1) == (1, 0) and csv.after_line('c";"d', ",", 1) == (0, 0)
    assert csv.after_line("", ";", 0) == (0, 0) and csv.after_line("a\rb", ";", 0) == (0, 2)


def test_lines_are_parsed_once_where_both_starts_agree(monkeypatch):
    parsed, after = [], csv.after_lines
    monkeypatch.setattr(csv, "after_lines", lambda lines, *a: parsed.append(len(lines)) or after(lines, *a))
    lines = [x for i in range(2000) for x in (f'"{i}","x;""y"",'.encode(), f'z {i}","{i}"'.encode())]
    facts = csv.Facts("f", 0, csv.SEPARATORS)
    facts.take(lines)
    assert sum(parsed) < 1.1 * len(csv.SEPARATORS) * len(lines)
    texts = [x.decode() for x in lines]
    for s, separator in enumerate(csv.SEPARATORS):
        for start in (csv.OUTSIDE, csv.INSIDE):
            assert tuple(facts.tracks[start][s]) == after(texts, separator, start)


def test_settled_rows_are_not_read_in_the_ranges_of_the_lines(spark, tmp_path, monkeypatch):
    name, joined, seen = "spark.sql.files.maxPartitionBytes", csv._joined, []
    monkeypatch.setattr(csv, "_joined", lambda *a: seen.append(spark.conf.get(name)) or joined(*a))
    (tmp_path / "a.csv").write_bytes(b'a;b\n' + b'1;"x\ny"\n' * 300)
    assert csv.scan_csv(spark, str(tmp_path), range_bytes=64).count() == 300
    assert seen == [spark.conf.get(name)] and seen != ["64"]


def test_strict_csv_stops_whatever_is_read(spark, tmp_path):
    (tmp_path / "long.csv").write_bytes(b"a;b\n1;2\n3;4;5\n")
    with pytest.raises(Exception, match="more cells than columns in row 2"):
        csv.read_csv(spark, str(tmp_path)).select("a").collect()
    assert [r["_extra"] for r in csv.read_csv(spark, str(tmp_path), strict=False).orderBy("_row").collect()] == [None, ["5"]]


def test_tables(spark):
    df = spark.range(5)
    assert tables.query(spark, "SELECT sum(id) AS s FROM {t}", t=df).first()["s"] == 10
    assert [r["id"] for r in tables.iterate(df.orderBy("id"))] == [0, 1, 2, 3, 4]
    assert tables.documents_query("s.t", "DOCUMENTO", [3, 4]) == "SELECT * FROM s.t WHERE DOCUMENTO IN (3, 4)"
    with pytest.raises(ValueError):
        tables.documents_query("s.t", "DOCUMENTO", ["1; DROP"])


def test_landing_takes_each_file_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "k string, v int"

    def send(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source / name))

    def run():
        land_and_wait(spark, str(source), out, "k", lambda b: b, schema=schema, checkpoint=checkpoint, recursiveFileLookup="true")

    send("1", [("a", 1), ("b", 2)])
    run()
    run()
    send("2", [("b", 3)])
    run()
    assert _rows(History(spark, out, "k").read().select("k", "v")) == [("a", 1), ("b", 3)]


def test_a_batch_that_is_retried_changes_nothing(spark, tmp_path):
    """After a commit the stream may present its last batch again; the marks know its files."""
    table = History(spark, str(tmp_path / "h"), "k")
    rows = spark.createDataFrame([("a", 1, "f1", 5), ("a", 2, "f2", 9), ("b", 3, "f1", 5)], "k string, v int, _file string, t int")
    rows = rows.withColumn("_time", F.timestamp_seconds("t")).drop("t")
    for turn in range(2):
        due, marks = newer_rows(rows, "k", table.marks())
        assert marks.count() == (0 if turn else 2)
        if not turn:
            table.replace(due, marks=marks)
    late = rows.where("v = 3").withColumns({"_time": F.timestamp_seconds(F.lit(4)), "v": F.lit(7)})
    assert newer_rows(late, "k", table.marks())[1].isEmpty()
    table.upsert(spark.createDataFrame([(3, "x")], "v int, w string").select("v"), ["v"])
    assert _rows(table.read(), ) == [("a", 2), ("b", 3)] and table.marks().count() == 2


def test_a_dropped_origin_takes_one_file_at_a_time(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, age in enumerate((50, 90, 10)):
        spark.createDataFrame([("a", i)], "k string, v int").coalesce(1).write.parquet(str(source / str(i)))
        for f in (source / str(i)).glob("*.parquet"):
            os.utime(f, (time.time() - age * 86_400,) * 2)
    land_and_wait(spark, str(source), out, "k", lambda b: b.select("k", "v"), schema="k string, v int", recursiveFileLookup="true")
    assert _rows(History(spark, out, "k").read()) == [("a", 2)]
    with pytest.raises(ValueError):
        land_and_wait(spark, str(source), out, "k", lambda b: b.select("k", "v"), schema="k string, v int", files_per_batch=2)


def test_csv_names_line_breaks_and_long_rows(spark, tmp_path):
    folder = tmp_path / "a b%20+[x]"
    folder.mkdir()
    (folder / "remesa 20251104.csv").write_bytes('a;b\n1;"x\ny"\n2;z;;\n'.encode())
    df = csv.read_csv(spark, str(tmp_path))
    assert [(r["a"], r["b"]) for r in df.orderBy("_row").collect()] == [("1", "x\ny"), ("2", "z")]
    assert df.first()["_file"].endswith("/a b%20+[x]/remesa 20251104.csv")
    (folder / "long.csv").write_bytes(b"a;b\n3;4;5\n")
    assert [r["extra"] for r in csv.overlong_rows(csv.scan_csv(spark, str(tmp_path))).collect()] == [["5"]]
    assert csv.read_csv(spark, str(tmp_path), strict=False).where("a = 3").first()["_extra"] == ["5"]
    with pytest.raises(Exception, match="more cells than columns"):
        csv.read_csv(spark, str(tmp_path)).collect()


def test_workbook_calendar_and_missing_extension(spark, tmp_path):
    content = write_workbook({"Base": {0: ["Día"], 1: [date(2025, 9, 5)]}})
    source, moved = io.BytesIO(content), io.BytesIO()
    with zipfile.ZipFile(source) as old, zipfile.ZipFile(moved, "w") as new:
        for name in old.namelist():
            text = old.read(name).decode()
            new.writestr(name, text.replace("<sheets>", '<workbookPr date1904="1"/><sheets>') if name == "xl/workbook.xml" else text)
    (tmp_path / "sin extension").write_bytes(moved.getvalue())
    (tmp_path / "otro.txt").write_bytes(b"x")
    got = workbook.read_workbooks(spark, str(tmp_path), extensions=(".xlsx", "")).where("_row = 1").collect()
    assert [r["cells"] for r in got] == [["2029-09-06 00:00:00"]]
    assert workbook.read_workbooks(spark, str(tmp_path)).count() == 0


def test_keys_stay_as_written(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([("007", 1), ("2025-01-01", 2), ("abc", 3)], "k string, v int")
    history.replace_partition(df, path, "k")
    stored = history.read_history(spark, path)
    assert {r["k"] for r in stored.collect()} == {"007", "2025-01-01", "abc"}
    assert {r["accion"] for r in history.load_summary(df, "k", stored).collect()} == {history.REPLACED}
    plan = stored.where(F.col("k").isin("007"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    whole = spark.createDataFrame([(202503, 1)], "k long, v int")
    assert history.load_summary(whole, "k", stored).first()["accion"] == history.INSERTED


def test_listed_replace_may_read_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "h")
    history.replace_partition(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int"), path, "k")
    more = history.read_history(spark, path).where("k <> 'c'").withColumn("v", F.col("v") + 10)
    history.replace_partition(more, path, "k", ["a", "c"])
    assert _rows(history.read_history(spark, path).select("k", "v")) == [("a", 11), ("b", 12), ("b", 2)]


def test_statements_run_to_their_end(spark):
    assert export.run_statement(spark, "SELECT 1")["ok"]
    assert not export.run_statement(spark, "SELECT raise_error('x') FROM range(3)")["ok"]


def test_settled_data_is_deleted_by_its_owner(spark):
    from rosterflow.session import scratch, settle, shared_dir

    def places():
        root = f"{shared_dir(spark)}/rosterflow"
        return set(os.listdir(root)) if os.path.isdir(root) else set()

    before = places()
    with scratch():
        settle(spark.range(3), "gone")
        with scratch():
            settle(spark.range(3), "gone-too")
            kept = settle(spark.range(3), "kept", outlives=True)
        assert kept.count() == 3
        assert len(places() - before) == 2
    assert places() == before
