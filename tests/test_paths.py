"""End-to-end paths on the smallest driver tables (short k-means)."""
from sessionkit.plans import paths
from sessionkit.session import scratch_path
from sessionkit.sources.adapter import load_events

SF_SMALL = "/root/testdata/sf0.001"


def test_process_and_segment_paths(spark):
    ev = load_events(spark, SF_SMALL)
    out = scratch_path(spark, "t-ready")
    bal = {r.is_abandoned: r["count"] for r in paths.process_sessions(ev, out).collect()}
    assert bal == {0: 366 - 105, 1: 105}
    res = paths.segment_sessions(ev, scratch_path(spark, "t-seg"), k=4, n_init=2, max_iter=10)
    an = res["analysis"].collect()
    assert sum(r.session_count for r in an) == res["sessions"].count()
    assert res["names"].count() == len(an)
    assert [r.behavior_cluster for r in res["analysis"].orderBy("behavior_cluster").collect()] \
        == list(range(len(an)))


def test_cli_process_step(spark, capsys):
    from sessionkit import cli
    out = scratch_path(spark, "t-cli-ready")
    cli.main(["process", "--sf-dir", SF_SMALL, "--out", out])
    assert spark.read.parquet(out).count() == 366
    assert "is_abandoned" in capsys.readouterr().out


def test_convert_monthly_csv(spark, tmp_path):
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    oct_, nov = tmp_path / "2019-Oct.csv", tmp_path / "2019-Nov.csv"
    oct_.write_text(head + "2019-10-01 00:00:00 UTC,view,5,9,,b,12.5,7,s1\n")
    nov.write_text(head + "2019-11-01 00:00:00 UTC,cart,6,9,a.b,c,3.25,8,s2\n")
    out = scratch_path(spark, "t-conv")
    dec = dict((c, n) for c, _, n in paths.convert_monthly_csv(
        spark, {"2019-Oct": str(oct_), "2019-Nov": str(nov)}, out))
    assert dec["product_id"] == "tinyint" and dec["price"] == "float"
    df = paths.events_from(spark, out, months=["2019-Nov"])
    rows = df.collect()
    assert len(rows) == 1 and rows[0].event_type == "cart" and rows[0].price == 3.25


def test_label_events_path(spark):
    out = scratch_path(spark, "t-labeled")
    df = paths.label_events(load_events(spark, SF_SMALL), out)
    assert df.count() == 799 and dict(df.dtypes)["is_abandoned"] == "boolean"


def test_convert_monthly_csv_ids_follow_file_order(spark, tmp_path):
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    a, b = tmp_path / "2019-Oct.csv", tmp_path / "2019-Nov.csv"
    a.write_text(head + "".join(f"2019-10-01 00:00:{i:02d} UTC,view,{i},9,,b,1.0,7,s{i}\n" for i in range(5)))
    b.write_text(head + "".join(f"2019-11-01 00:00:{i:02d} UTC,view,{i},9,,b,1.0,7,t{i}\n" for i in range(5)))
    out = scratch_path(spark, "t-conv-ids")
    paths.convert_monthly_csv(spark, {"2019-Oct": str(a), "2019-Nov": str(b)}, out)
    rows = paths.events_from(spark, out).collect()
    assert len({r.event_id for r in rows}) == 10
    oct_max = max(r.event_id for r in rows if r.source_month == "2019-Oct")
    assert all(r.event_id > oct_max for r in rows if r.source_month == "2019-Nov")


def test_champion_path_saves_model_and_importances(spark):
    from sessionkit.operators import sessions as S
    from sessionkit.plans import models as M
    from sessionkit.plans import paths
    from sessionkit.session import materialize, scratch_path
    from sessionkit.sources.adapter import load_events
    table = materialize(S.build_model_ready(load_events(spark, "/root/testdata/sf0.001")), "t-ready")
    out = scratch_path(spark, "t-results")
    imp = paths.train_champion(spark, table.inputFiles()[0].rsplit("/", 1)[0], out,
                               {"n_estimators": 3, "max_depth": 3}).collect()
    assert abs(sum(r.Importance for r in imp) - 1) < 1e-9
    again = M.Champion.load(spark, f"{out}/champion_pipeline")
    assert len(again.booster.trees) == 3 and again.transform(table).count() == table.count()
