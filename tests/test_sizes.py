"""What keeps a task's work and memory bounded when tables grow."""

from types import SimpleNamespace

from rosterflow.plans import roster
from rosterflow.plans.roster import load_into_history, load_roster
from rosterflow.queries import rosters
from rosterflow.session import DEFAULTS, compile_split_code
from rosterflow.sources.contracts import CONTRACTS

SF = "/root/testdata/sf0.001"


def test_a_month_of_many_orders_comes_in_several_workbooks_and_loads_the_same_rows(spark):
    case = next(c for c in rosters.CASES if c.source == "planes")
    whole, dealt = case.scanned(spark, SF), case.scanned(spark, SF, 500)
    assert dealt.select("_file").distinct().count() > whole.select("_file").distinct().count()
    wanted, found = (sorted(map(repr, load_roster(x, CONTRACTS["planes"]).rows.collect())) for x in (whole, dealt))
    assert wanted and found == wanted


def test_a_session_built_elsewhere_gets_split_code():
    name = "spark.sql.codegen.hugeMethodLimit"
    for configured, wanted in (({}, {name: DEFAULTS[name]}), ({name: "9000"}, {})):
        changed = {}
        context = SimpleNamespace(getConf=lambda known=configured: SimpleNamespace(contains=known.__contains__))
        compile_split_code(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(set=changed.__setitem__)))
        assert changed == wanted


def test_what_a_path_tells_is_told_once_per_file(spark):
    case = next(c for c in rosters.CASES if c.source == "ripley_life")
    load = load_roster(case.scanned(spark, SF), CONTRACTS["ripley_life"])
    plan = load.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "NUMERO_ARCHIVO" in plan and r"(20\d{2})" not in plan


def test_a_history_loaded_twice_is_typed_once(spark, tmp_path, monkeypatch):
    case = next(c for c in rosters.CASES if c.source == "stock")
    load, seen = load_roster(case.scanned(spark, SF), CONTRACTS["stock"]), []
    wanted = load.rows.count()
    monkeypatch.setattr(rosters, "load_into_history", lambda x, path: seen.append(x.rows) or load_into_history(x, path))
    assert rosters._through_history(load, spark, f"{tmp_path}/h").count() == wanted
    assert len(seen) == 2 and not any("rlike" in x._jdf.queryExecution().optimizedPlan().toString().lower() for x in seen)


def test_a_scan_written_by_one_task_is_typed_by_several(spark, monkeypatch):
    monkeypatch.setattr(roster, "SCANNED_ROWS", 200)
    case = next(c for c in rosters.CASES if c.source == "servihabit")
    whole, one = case.scanned(spark, SF), case.scanned(spark, SF).coalesce(1)
    load = load_roster(one, CONTRACTS["servihabit"])
    assert sum("/scanned-" in x for x in load.rows.inputFiles()) > 5
    wanted, found = (sorted(map(repr, x.collect())) for x in (load_roster(whole, CONTRACTS["servihabit"]).rows, load.rows))
    assert wanted and found == wanted
