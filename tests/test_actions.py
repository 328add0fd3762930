from datetime import datetime

from recoflow.operators import actions
from recoflow.schema import USER_ACTION


def scan(spark, lines):
    data = [(t, read, ch, (a, user, art, "C2")) for t, read, ch, a, user, art in lines]
    return actions.actions_scan(spark.createDataFrame(data, USER_ACTION))


def test_exposure_list_becomes_one_row_per_article(spark, rows):
    df = scan(spark, [("2019-03-01 10:00:00", "", 18, "exposure", "2", "[1,2,3]")])
    out = actions.action_flags(df).select("article_id", "shared", "clicked", "collected", "exposure")
    assert rows(out) == [(i, False, False, False, True) for i in (1, 2, 3)]


def test_flags_of_one_article_are_combined(spark):
    df = scan(spark, [("2019-03-01 10:00:00", "", 18, "share", "2", "7"),
                      ("2019-03-01 11:00:00", "", 18, "click", "2", "7"),
                      ("2019-03-01 09:00:00", "", 18, "collect", "2", "7")])
    row = actions.fold_actions(df).collect()[0]
    assert row["shared"] and row["clicked"] and row["collected"] and row["exposure"]
    assert row["action_time"] == "2019-03-01 11:00:00"


def test_read_time_maximum_is_numeric(spark):
    df = scan(spark, [("t", r, 1, "read", "2", "7") for r in ("900", "1200", "")])
    assert actions.fold_actions(df).collect()[0]["read_time"] == 1200.0


def test_invalid_ids_drop_out(spark, rows):
    df = scan(spark, [("t", "", 1, "exposure", "2", "oops"), ("t", "", 1, "click", "2", "x"),
                      ("t", "", 1, "exposure", "2", "[]"), ("t", "", 1, "click", "2", "5")])
    assert rows(actions.action_flags(df).select("article_id")) == [(5,)]


def test_merge_equals_folding_everything(spark, rows):
    old = scan(spark, [("a", "5", 1, "click", "2", "7"), ("b", "", 1, "exposure", "2", "[7,8]")])
    new = scan(spark, [("c", "9", 1, "share", "2", "8"), ("d", "", 1, "read", "3", "7")])
    merged = actions.merge_actions(actions.fold_actions(old), new)
    assert rows(merged) == rows(actions.fold_actions(old.union(new)).select(*merged.columns))


def test_partition_bound_is_inclusive(spark):
    data = [("t", "", 1, ("click", "1", "1", "C2"), d)
            for d in (datetime(2019, 3, 14).date(), datetime(2019, 3, 15).date(), datetime(2019, 3, 16).date())]
    from pyspark.sql import types as T
    log = spark.createDataFrame(data, T.StructType([*USER_ACTION.fields, T.StructField("dt", T.DateType())]))
    assert actions.actions_scan(log, "2019-03-15").count() == 2
