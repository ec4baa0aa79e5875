from pathlib import Path

import pytest
from conftest import rows

from footfall import operators as op
from footfall import sinks
from footfall.__main__ import main
from footfall.plans import warehouse
from footfall.schemas import DETAIL, LAYERS, RAW, TABLES
from footfall.sources import load_raw, read_layer, read_result_csv, split_rejects

LINES = """1,71,7,pv,1511570000
1,82,8,pv,1511573600
1,93,9,buy,1511577200
2,64,6,pv,1511580800
2,64,6,pv,1511580800
2,75,7,cart,1511667200
"""


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(LINES)
    return str(path)


def test_raw_csv_uses_the_declared_schema(spark, csv):
    raw = load_raw(spark, csv)
    assert raw.schema.simpleString() == RAW.simpleString()
    assert raw.count() == 6 and op.has_rows(raw)


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("1,2,3,pv,4\n1,2,3,pv\n1,2,3,pv,4,5\nx,2,3,pv,4\n,2,3,pv,4\n")
    assert load_raw(spark, str(path)).filter("user_id is null").count() == 2
    strict = load_raw(spark, str(path), drop_malformed=True)
    want = [(None, 2, 3, "pv", 4), (1, 2, 3, "pv", 4)]  # an empty field is not malformed
    assert sorted(rows(strict), key=str, reverse=True) == want
    # whether a line is well formed does not depend on the columns asked for
    assert strict.select("behavior").count() == 2
    assert strict.groupBy("behavior").count().collect()[0][1] == 2
    good, rejected = split_rejects(spark, str(path))
    assert good.count() == 2
    assert sorted(rows(rejected)) == [
        ("1,2,3,pv", "fields"), ("1,2,3,pv,4,5", "fields"), ("x,2,3,pv,4", "user_id"),
    ]


def test_whole_build_in_folders(spark, csv, tmp_path):
    root = str(tmp_path / "wh")
    audit = warehouse.build_all(spark, csv, root)
    assert rows(audit) == [(6, 0, 0, 0, 1, 5, 83.33)]
    detail = read_layer(spark, warehouse.DETAIL_TABLE, root)
    assert detail.schema.simpleString() == DETAIL.simpleString()
    assert sorted({r[8] for r in rows(detail)}) == ["2017-11-25", "2017-11-26"]
    for name, schema in TABLES.items():
        stored = read_layer(spark, name, root)
        assert op.has_rows(stored), name
        assert stored.schema.simpleString() == schema.simpleString()
    assert rows(read_layer(spark, "ads.daily_pv_uv", root)) == rows(op.daily_pv_uv(detail))
    checks = warehouse.verify(spark, root)
    assert rows(checks["raw"]) == [(6,)]
    assert rows(checks["detail"]) == [(5, 2, 5, 4, "2017-11-25", "2017-11-26")]
    out = str(tmp_path / "out")
    warehouse.export_reports(spark, out, root)
    for name in warehouse.reports():
        parts = list(Path(out, name.split(".")[1]).glob("part-*.csv"))
        assert len(parts) == 1, name
        header = parts[0].read_text().splitlines()[0]
        assert header == ",".join(TABLES[name].names)
        back = read_result_csv(spark, f"{out}/{name.split('.')[1]}", name)
        assert sorted(map(str, rows(back))) == sorted(map(str, rows(read_layer(spark, name, root))))


def test_one_day_is_replaced_without_touching_the_others(spark, csv, tmp_path):
    root = str(tmp_path / "wh")
    warehouse.build_all(spark, csv, root)
    days = Path(root, "dwd", "user_behavior_detail")
    kept = sorted(p.name for p in (days / "event_date=2017-11-26").iterdir())
    before = sorted(rows(read_layer(spark, warehouse.DETAIL_TABLE, root)))
    audit = warehouse.build_detail(
        spark, root, "2017-11-25", "2017-11-25", replace_days_only=True
    )
    assert rows(audit)[0][5] == 4
    assert sorted(rows(read_layer(spark, warehouse.DETAIL_TABLE, root))) == before
    assert sorted(p.name for p in (days / "event_date=2017-11-26").iterdir()) == kept
    one = warehouse.build_detail(spark, root, "2017-11-26", "2017-11-26")
    assert rows(one)[0][5] == 1
    assert read_layer(spark, warehouse.DETAIL_TABLE, root).count() == 1


def test_empty_layers_stop_the_build(spark, tmp_path):
    root, path = str(tmp_path / "wh"), tmp_path / "none.csv"
    path.write_text("")
    warehouse.build_raw(spark, str(path), root)
    assert not Path(root).exists()
    sinks.save(spark.createDataFrame([], RAW), warehouse.RAW_TABLE, root)
    assert warehouse.build_detail(spark, root) is None


def test_catalog_tables(spark, csv):
    sinks.create_databases(spark)
    assert set(LAYERS) <= {d.name for d in spark.catalog.listDatabases()}
    for name in TABLES:
        sinks.create_table(spark, name)
    listed = {f"{r[0]}.{r[1]}" for r in rows(sinks.list_tables(spark))}
    assert set(TABLES) <= listed
    described = rows(sinks.describe(spark, warehouse.DETAIL_TABLE))
    assert described[0] == ("user_id", "bigint", False)
    assert described[-1] == ("event_date", "string", True)
    warehouse.build_all(spark, csv)
    assert spark.table("ads.top_items").count() == 5
    assert spark.table(warehouse.DETAIL_TABLE).count() == 5
    again = warehouse.build_detail(spark, None, "2017-11-26", "2017-11-26", replace_days_only=True)
    assert rows(again)[0][5] == 1
    assert spark.table(warehouse.DETAIL_TABLE).count() == 5
    sinks.create_table(spark, warehouse.DETAIL_TABLE)
    for day in ("2017-11-25", "2017-11-26"):
        warehouse.build_detail(spark, None, day, day, replace_days_only=True)
    assert spark.table(warehouse.DETAIL_TABLE).count() == 5
    for name in TABLES:
        spark.sql(f"DROP TABLE {name}")


def test_export_head_is_ordered(spark, tmp_path):
    df = spark.createDataFrame([(i, f"{i}") for i in range(100)], "a int, b string")
    sinks.export_csv(df, str(tmp_path / "x"), head=3, order=("a",), single_file=True)
    lines = [p.read_text() for p in (tmp_path / "x").glob("part-*.csv")]
    assert lines == ["a,b\n0,0\n1,1\n2,2\n"]


def test_retention_offsets_in_the_build(spark, csv, tmp_path, monkeypatch):
    import footfall.__main__ as cli

    monkeypatch.setattr(cli, "session", lambda *args, **kwargs: spark)
    root, out = str(tmp_path / "wh"), tmp_path / "out"
    main(["all", "--csv", csv, "--root", root, "--retention", "1,7,14"])
    main(["export", "--root", root, "--out", str(out), "--retention", "1,7,14"])
    head = next((out / "retention").glob("part-*.csv")).read_text().splitlines()[0]
    assert head == "first_date,new_users,day_1,day_7,day_14"


def test_command_line(spark, csv, tmp_path, capsys, monkeypatch):
    import footfall.__main__ as cli

    monkeypatch.setattr(cli, "session", lambda *args, **kwargs: spark)
    root = str(tmp_path / "wh")
    main(["all", "--csv", csv, "--root", root])
    main(["export", "--root", root, "--out", str(tmp_path / "out")])
    main(["verify", "--root", root])
    printed = capsys.readouterr().out
    assert "83.33" in printed and "2017-11-26" in printed
    assert (tmp_path / "out" / "user_path").exists()
