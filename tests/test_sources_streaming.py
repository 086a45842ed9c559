"""Sources/sinks on generated entity files, and stream = batch tests."""

import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelkit.plans.check import compare, duckdb_connection
from panelkit.sources import files, sinks
from panelkit.streaming import stateful as ST

from conftest import SF_SMALL


def _write_psv(path, header, rows, sep="|"):
    with open(path, "w") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            fh.write(sep.join("" if v is None else str(v) for v in r) + "\n")


@pytest.fixture()
def entity_dir(tmp_path):
    schema = files.raw_schema(with_corrupt=False)
    header = [f.name for f in schema.fields]
    idx = {n: i for i, n in enumerate(header)}

    def row(hour, hr=None, label=0):
        r = [None] * len(header)
        r[idx["HR"]], r[idx["Temp"]], r[idx["ICULOS"]], r[idx["SepsisLabel"]] = hr, 37.0, hour, label
        r[idx["Age"]], r[idx["Gender"]] = 60.0, 1.0
        return r

    _write_psv(tmp_path / "p000001.psv", header, [row(1, None), row(2, 80.0), row(3, None)])
    _write_psv(tmp_path / "p000002.psv", header, [row(1, 120.0, 1)])
    (tmp_path / "p000003.psv").write_text("")                      # empty file
    with open(tmp_path / "p000004.psv", "w") as fh:                # one malformed line
        fh.write("|".join(header) + "\n" + "not|a|number|row\n")
    (tmp_path / "notes.txt").write_text("ignored")
    return str(tmp_path)


def test_read_entity_files_one_scan(spark, entity_dir):
    panel, quarantine = files.read_panel_files(spark, entity_dir)
    got = sorted((r["patient_id"], r["iculos"], r["hr"]) for r in panel.select("patient_id", "iculos", "hr").collect())
    assert got == [("p000001", 1, None), ("p000001", 2, 80.0), ("p000001", 3, None), ("p000002", 1, 120.0)]
    assert [r["file_name"] for r in quarantine.collect()] == ["p000004.psv"]
    assert "hr" in panel.columns and "o2sat" in panel.columns


def test_files_read_by_header_and_bad_files_set_aside(spark, entity_dir):
    from pathlib import Path

    from panelkit.plans import jobs
    d = Path(entity_dir)
    (d / "p000005.psv").write_text("ICULOS|Extra|HR|SepsisLabel\r\n1|x|91.5|0\r\n2|y|NaN|1\r\n")   # another order
    (d / "p000006.psv").write_text("a|b\n1|2\n")                                       # no such header
    (d / "p000007.psv").write_text("HR|ICULOS\n70|1\n71|2|3\nhigh|3\n")               # two bad lines
    panel, quarantine = files.read_panel_files(spark, entity_dir)
    assert panel.count() == 7
    got = {(r["patient_id"], r["iculos"]): (r["hr"], r["sepsislabel"]) for r in panel.collect()}
    assert got[("p000005", 1)] == (91.5, 0) and got[("p000005", 2)] == (None, 1)
    assert got[("p000007", 1)] == (70.0, None) and got[("p000001", 2)] == (80.0, 0)
    bad = sorted((r["file_name"], r["reason"]) for r in quarantine.collect())
    assert bad == [("p000004.psv", "number of fields"), ("p000006.psv", "no header"), ("p000006.psv", "no header"),
                   ("p000007.psv", "number of fields"), ("p000007.psv", "value")]
    out = str(d / "out")
    written = jobs.ingest(spark, entity_dir, out)
    assert written.count() == 7 and spark.read.parquet(f"{out}/quarantine").count() == 5
    first = {r["iculos"]: r["hr"] for r in written.filter("patient_id = 'p000001'").collect()}
    assert first == {1: 80.0, 2: 80.0, 3: 80.0}  # forward, then backward fill


def test_clean_write_and_reload_comma_files(spark, entity_dir, tmp_path):
    from panelkit.operators import clean
    from panelkit.operators.panel import PanelSpec
    panel, _ = files.read_panel_files(spark, entity_dir)
    imputed = clean.fill_forward_backward(panel, PanelSpec("patient_id", ("iculos",)), ["hr"])
    out = str(tmp_path / "clean")
    sinks.write_clean(imputed.select("patient_id", "iculos", "hr"), out, fmt="csv")
    back = spark.read.option("header", True).schema("patient_id string, iculos int, hr double").csv(out)
    assert sorted((r["patient_id"], r["iculos"], r["hr"]) for r in back.collect()) == [
        ("p000001", 1, 80.0), ("p000001", 2, 80.0), ("p000001", 3, 80.0), ("p000002", 1, 120.0)]


def test_bucketed_feature_table_and_metrics(spark, tmp_path):
    from panelkit.operators.panel import VITAL_PANEL
    from panelkit.plans.q_panel import features
    f = features(spark, SF_SMALL)
    sinks.write_feature_table(f, "patient_features_test", VITAL_PANEL, buckets=4)
    t = spark.table("patient_features_test")
    assert t.count() == f.count()
    prof = t.groupBy("patient_id").agg(F.avg("hr"))
    assert "Exchange hashpartitioning" not in prof._jdf.queryExecution().executedPlan().toString()
    m = sinks.metrics_frame(spark, "forecast", "Exp Smoothing", {"rmse": 1.5, "mae": 1.0})
    sinks.write_metrics(m, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == 2
    spark.sql("DROP TABLE IF EXISTS patient_features_test")


def _split_events(src, dest, parts, only=None):
    """Write the events in time order as ``parts`` files with increasing mtimes."""
    table = pq.read_table(src).sort_by([("ts", "ascending"), ("event_id", "ascending")])
    n = table.num_rows
    now = time.time() - 1000
    for i in range(parts):
        if only is not None and i not in only:
            continue
        chunk = table.slice(i * n // parts, (i + 1) * n // parts - i * n // parts)
        path = os.path.join(dest, f"events_{i:02d}.parquet")
        pq.write_table(chunk, path)
        os.utime(path, (now + 10 * i, now + 10 * i))


def test_stream_over_many_batches_equals_batch(spark, tmp_path):

    from panelkit.plans.catalog import all_queries
    d = tmp_path / "ev"
    d.mkdir()
    _split_events(f"{SF_SMALL}/events.parquet", str(d), 4)
    got = ST.stream_features(spark, str(d / "events_*.parquet"), max_files=1)
    from panelkit.plans.registry import finish
    got = finish(got.select(*ST.OUT_COLS)).toPandas()
    want = duckdb_connection(SF_SMALL).execute(all_queries()["stream_rolling_features"].sql).fetchdf()
    ok, msg = compare(got, want)
    assert ok, msg


def test_alert_log_exactly_once(spark, tmp_path):
    d = tmp_path / "ev"
    d.mkdir()
    _split_events(f"{SF_SMALL}/events.parquet", str(d), 2, only={0})
    log, ckpt = str(tmp_path / "log"), str(tmp_path / "ckpt")
    n1 = ST.append_alert_log(spark, str(d / "events_*.parquet"), log, ckpt).count()
    n1b = ST.append_alert_log(spark, str(d / "events_*.parquet"), log, ckpt).count()
    assert n1 == n1b > 0
    _split_events(f"{SF_SMALL}/events.parquet", str(d), 2, only={1})
    n2 = ST.append_alert_log(spark, str(d / "events_*.parquet"), log, ckpt)
    assert n2.count() > n1 and n2.select("id").distinct().count() == n2.count()


def test_inventory_required_columns_tables_and_log(spark, entity_dir, tmp_path):
    from panelkit.operators import quality
    raw = files.with_entity_from_filename(files.read_entity_files(spark, entity_dir))
    clean, _ = files.split_quarantine(raw)
    # Four .psv files found, three contributed lines (one is empty)
    assert files.files_found(raw) == 4
    assert files.entity_inventory(raw).first()["files"] == 3
    # Q2: required columns / minimum column count / tables, without a job
    checks = dict((c[0], c[3]) for c in quality.required_columns(clean, ["HR", "ICULOS", "nope"], 60))
    assert checks["has_HR"] and checks["has_ICULOS"] and not checks["has_nope"] and not checks["min_columns"]
    sinks.replace_table(clean.select("patient_id", "ICULOS", "HR"), "patient_vitals_test")      # A7
    sinks.replace_table(clean.select("patient_id", "ICULOS", "HR"), "patient_vitals_test")
    assert spark.table("patient_vitals_test").count() == 4
    assert dict((c[0], c[3]) for c in quality.tables_exist(spark, ["patient_vitals_test"]))["table_patient_vitals_test"]
    spark.sql("DROP TABLE patient_vitals_test")
    # Append scored rows to the prediction log twice
    rows = spark.createDataFrame([(1, "p1", 101.0, 38.0, "HIGH RISK")], sinks.LOG_SCHEMA)
    log = str(tmp_path / "log")
    sinks.append_log(rows, log)
    sinks.append_log(rows, log)
    assert spark.read.parquet(log).count() == 2


def test_late_rows_are_dropped_not_applied(spark, tmp_path):
    """Newer events arrive first, older ones in a later micro-batch: the older
    rows are late (behind the watermark and behind each entity's last row) and
    must not be emitted or folded into the state."""
    d = tmp_path / "ev"
    d.mkdir()
    table = pq.read_table(f"{SF_SMALL}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    n = table.num_rows
    early, late_half = table.slice(0, n // 2), table.slice(n // 2, n - n // 2)
    now = time.time() - 1000
    for name, part, t in (("b_newer.parquet", late_half, now), ("a_older.parquet", early, now + 10)):
        pq.write_table(part, str(d / name))
        os.utime(d / name, (t, t))
    out = ST.stream_features(spark, str(d / "*.parquet"), max_files=1)
    assert out.count() == late_half.num_rows
    # ordinals restart from the first row seen per entity and stay dense
    gaps = out.groupBy("patient_id").agg((F.max("iculos") - F.count(F.lit(1))).alias("g"))
    assert gaps.filter(F.col("g") != 0).count() == 0


def test_state_function_has_no_series_per_entity(monkeypatch):
    """Rolling values of one entity in NumPy: equal to pandas, nulls and infinities too."""
    import numpy as np
    import pandas as pd
    from panelkit.streaming import stateful
    x = np.array([1.5, np.nan, np.inf, 4.0, 4.0, 4.0, np.nan, np.nan, np.nan, 7.25, -3.0])
    want = {w: pd.Series(x).rolling(w, min_periods=1) for w in (3, 6)}
    for w, r in want.items():
        np.testing.assert_allclose(stateful._rolling_mean(x, w), r.mean().to_numpy())
        np.testing.assert_allclose(stateful._rolling_std(x, w), r.std().fillna(0.0).to_numpy(), atol=1e-12)
    np.testing.assert_array_equal(stateful._ffill(np.array([np.nan, 2.0, np.nan]), 9.0), [9.0, 2.0, 2.0])
    np.testing.assert_array_equal(stateful._ffill(np.array([np.nan, 2.0, np.nan]), None), [np.nan, 2.0, 2.0])
