"""Sources and sinks: catalog resolution, typed projection, writes."""

from __future__ import annotations

import os
import tempfile

import pytest

from tessera.sources import SourceCatalog, materialize, read_history, write_history, write_report
from tessera.sources.schemas import SOURCE_SCHEMAS


def test_catalog_resolves_parquet_by_name_and_projects_types(spark):
    cat = SourceCatalog(spark, parquet_root="/root/testdata/sf0.001")
    assert cat.has("orders") and not cat.has("no_such_table")
    with pytest.raises(KeyError):
        cat.raw("no_such_table")
    assert cat.raw("orders") is cat.raw("orders")          # resolved once


def test_fixture_tables_follow_declared_schemas(fixture_sources):
    for name, schema in SOURCE_SCHEMAS.items():
        if name == "rep_aliases":
            continue
        df = fixture_sources.table(name)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema], name


def test_history_round_trip_and_month_pruning(spark):
    import datetime as dt

    rows = [(dt.datetime(2026, 7, 1), "a"), (dt.datetime(2026, 8, 20), "b"), (None, "c")]
    df = spark.createDataFrame(rows, "d timestamp_ntz, v string")
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-hist-"), "h")
    write_history(df, path, "d", roll="2026-09-01")
    assert sorted(r["v"] for r in read_history(spark, path).collect()) == ["a", "b", "c"]
    pruned = read_history(spark, path, before="2026-08-11")
    assert sorted(r["v"] for r in pruned.collect()) == ["a", "b"]      # month bound; date filter is the report's
    assert pruned.columns == ["d", "v"]


def test_rolls_replace_themselves_alone(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2026, 7, 1), "a"), (dt.datetime(2026, 8, 20), "b")], "d timestamp_ntz, v string")
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-hist-"), "h")
    write_history(df, path, "d", roll="2026-09-01")
    later = spark.createDataFrame([(dt.datetime(2026, 9, 5), "c")], df.schema)
    write_history(later, path, "d", roll="2026-10-01")
    write_history(df.where("v = 'a'"), path, "d", roll="2026-09-01")
    assert sorted(r["v"] for r in read_history(spark, path).collect()) == ["a", "c"]


def _dated(spark, *rows):
    import datetime as dt

    return spark.createDataFrame([(d and dt.datetime.fromisoformat(d), v) for d, v in rows], "d timestamp_ntz, v string")


def _values(df):
    return sorted(r["v"] for r in df.collect())


def _history():
    return os.path.join(tempfile.mkdtemp(prefix="tessera-hist-"), "h")


def test_roll_into_a_plain_folder_keeps_its_rows(spark):
    path = _history()
    _dated(spark, ("2026-07-01", "a"), ("2026-08-01", "b"), (None, "n")).write.parquet(path)
    write_history(_dated(spark, ("2026-08-12", "c")), path, "d", roll="2026-09-01")
    assert _values(read_history(spark, path)) == ["a", "b", "c", "n"]
    write_history(_dated(spark, ("2026-09-12", "d")), path, "d", roll="2026-10-01")
    assert _values(read_history(spark, path)) == ["a", "b", "c", "d", "n"]
    assert _values(read_history(spark, path, before="2026-09-01")) == ["a", "b", "c", "n"]
    # a plain part whose rows reach into the roll: the roll's start decides, or it is refused
    other = _history()
    _dated(spark, ("2026-07-01", "a"), ("2026-08-20", "old")).write.parquet(other)
    with pytest.raises(Exception, match="a row is dated 2026-08-12"):
        write_history(_dated(spark, ("2026-08-12", "c")), other, "d", roll="2026-09-01")
    assert _values(read_history(spark, other)) == ["a", "old"]
    write_history(_dated(spark, ("2026-08-12", "c")), other, "d", roll="2026-09-01", start="2026-08-11")
    assert _values(read_history(spark, other)) == ["a", "c"]


def test_overlaps_and_gaps_are_refused(spark):
    path, rows = _history(), _dated(spark, ("2026-08-12", "a"), ("2026-09-12", "b"))
    write_history(rows, path, "d", roll="2026-09-01", start="2026-08-11")
    for start, end, why in (("2026-08-11", "2026-10-01", "overlaps"), ("2026-09-02", "2026-10-01", "gap"),
                            ("2026-08-01", "2026-09-01", "overlaps"), ("2026-09-01", "2026-09-01", "no day")):
        with pytest.raises(ValueError, match=why):
            write_history(rows, path, "d", roll=end, start=start)
    assert _values(read_history(spark, path)) == ["a"]
    write_history(rows.where("v = 'b'"), path, "d", roll="2026-10-01", start="2026-09-01")
    assert _values(read_history(spark, path)) == ["a", "b"]
    assert _values(read_history(spark, path, before="2026-09-01")) == ["a"]
    with pytest.raises(ValueError, match="would be missing"):
        read_history(spark, path, before="2026-10-02")
    assert _values(read_history(spark, path, before="2026-10-02", allow_gap=True)) == ["a", "b"]
    assert read_history(spark, path, before="2026-08-01").columns == ["d", "v"]
    assert read_history(spark, path, before="2026-08-01").count() == 0


def test_rolls_of_the_older_layout_are_read_once(spark):
    """Two rolls from the same start held rows twice; a plain part beside rolls was not read."""
    path = _history()
    _dated(spark, ("2026-07-01", "plain")).write.parquet(path)
    for end, rows in (("2026-09-01", [("2026-08-12", "a")]), ("2026-10-01", [("2026-08-12", "a"), ("2026-09-12", "b")])):
        (_dated(spark, *rows).selectExpr("*", "date_format(d, 'yyyy-MM') AS report_month").write
         .partitionBy("report_month").parquet(f"{path}/rolled_to={end}"))
    assert _values(read_history(spark, path, date_col="d")) == ["a", "b", "plain"]
    assert _values(read_history(spark, path, date_col="d", before="2026-09-01")) == ["a", "plain"]
    with pytest.raises(ValueError, match="date column"):
        read_history(spark, path)
    write_history(_dated(spark, ("2026-10-02", "c")), path, "d", roll="2026-11-01")
    assert _values(read_history(spark, path)) == ["a", "b", "c", "plain"]


def test_a_roll_counts_when_its_ledger_version_is_published(spark, monkeypatch):
    from tessera.sources.ledger import HistoryLedger

    path, rows = _history(), _dated(spark, ("2026-08-12", "a"))
    write_history(rows, path, "d", roll="2026-09-01", start="2026-08-11")
    folders = lambda: [n for n in os.listdir(path) if n.startswith("roll=")]
    # two jobs that read the same version: one of them fails and leaves nothing
    publish = HistoryLedger.publish

    def late(self, roll):
        monkeypatch.setattr(HistoryLedger, "publish", publish)
        write_history(_dated(spark, ("2026-09-02", "first")), path, "d", roll="2026-10-01")
        publish(self, roll)

    monkeypatch.setattr(HistoryLedger, "publish", late)
    with pytest.raises(RuntimeError, match="another job"):
        write_history(_dated(spark, ("2026-09-03", "second")), path, "d", roll="2026-10-01")
    assert _values(read_history(spark, path)) == ["a", "first"] and len(folders()) == 2
    # a write that fails before publishing adds nothing
    with pytest.raises(Exception, match="a row is dated"):
        write_history(rows, path, "d", roll="2026-11-01")
    assert _values(read_history(spark, path)) == ["a", "first"]
    # replaced rolls go, but not before the version after the next
    for v in ("b", "c", "d"):
        write_history(_dated(spark, ("2026-08-13", v)), path, "d", roll="2026-09-01")
    assert _values(read_history(spark, path)) == ["d", "first"]
    named = {r.folder for r in HistoryLedger.open(spark, path).rolls}
    assert named < set(folders()) and len(folders()) <= 4


def test_empty_roll(spark):
    path = _history()
    write_history(_dated(spark).where("false"), path, "d", roll="2026-09-01", start="2026-08-11")
    assert read_history(spark, path).count() == 0
    write_history(_dated(spark, ("2026-09-02", "a")), path, "d", roll="2026-10-01")
    assert _values(read_history(spark, path, before="2026-10-01")) == ["a"]


def test_sources_may_have_places_of_their_own(spark):
    root = tempfile.mkdtemp(prefix="tessera-places-")
    spark.range(3).write.parquet(f"{root}/a/x")
    spark.range(5).write.parquet(f"{root}/b/y")
    spark.range(7).createOrReplaceTempView("own_z")
    cat = SourceCatalog(spark, parquet_root=f"{root}/a", locations={"y": f"{root}/b/y", "z": "own_z", "w": f"{root}/none"})
    assert [cat.raw(n).count() for n in "xyz"] == [3, 5, 7]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        cat.raw("w")


def test_damaged_source_is_an_error(spark):
    root = tempfile.mkdtemp(prefix="tessera-bad-")
    os.makedirs(os.path.join(root, "tickets"))
    with open(os.path.join(root, "tickets", "part-0.parquet"), "w") as f:
        f.write("no parquet")
    cat = SourceCatalog(spark, parquet_root=root)
    with pytest.raises(Exception) as raised:
        cat.has("tickets")
    assert not isinstance(raised.value, KeyError)
    assert not cat.has("attendees")


def test_write_report_and_materialize(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-out-"), "r")
    write_report(df, path)
    assert spark.read.parquet(path).count() == 10
    cut = materialize(spark, df.where("id > 4"), "test")
    assert cut.count() == 5
    assert "Filter" not in cut._jdf.queryExecution().analyzed().toString()
