import pytest
from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.operators import selection
from urlaudit.plans import queries
from urlaudit.sources import projections

AS_OF = "2024-03-10"


def urls(spark, *rows):
    return spark.createDataFrame(rows, schema.URL)


def active(spark, *ids):
    return spark.createDataFrame([(i, 1, None, True) for i in ids], schema.URL_CONTEXT)


def checked(spark, *rows):
    df = spark.createDataFrame(rows, "url_id long, d string")
    return df.select("url_id", F.col("d").cast("timestamp_ntz").alias("checking_date"))


def test_due_counts_calendar_days(value):
    rows = [("2024-03-08 23:59:59",), ("2024-03-09 00:00:00",), ("2024-03-10 00:00:00",), (None,)]
    assert value(selection.is_due(F.col("d").cast("timestamp"), AS_OF), rows, "d string") == [True, False, False, True]


def test_due_urls_filters_and_orders(spark):
    url = urls(
        spark,
        (1, "http://a/1", "a", True, 1),
        (2, "http://a/2", "a", True, 9),
        (3, "http://a/3", "a", True, 1),
        (4, "http://a/4", "a", False, 9),
        (5, "http://a/5", "a", True, 9),
        (6, "http://hdl.handle.net/11/x", "hdl.handle.net", True, 9),
        (7, "http://b/7", None, True, 9),
        (8, "http://c/8", "c", True, 9),
    )
    context = active(spark, 1, 2, 2, 2, 3, 4, 6, 7, 8)
    status = checked(spark, (1, "2024-01-01"), (2, "2024-01-01"), (8, "2024-03-09 12:00:00"))
    due = selection.due_urls(url, status, context, AS_OF).collect()
    assert [(r.id, r.order_nr) for r in due] == [(2, 1), (3, 2), (1, 3)]  # never checked before old
    assert [r.id for r in selection.due_urls(url, status, context, AS_OF, per_group=1).collect()] == [2]
    assert [r.id for r in selection.due_urls(url, status, context, AS_OF, limit=2).collect()] == [2, 3]
    assert [r.id for r in selection.due_handles(url, status, context, AS_OF).collect()] == [6]
    assert selection.due_all(url, status, context, AS_OF).count() == 4


@pytest.mark.parametrize("ids,wanted", [([2], [1, 3]), ([2, None], []), ([], [1, 2, 3])])
def test_never_checked_follows_not_in(spark, ids, wanted):
    url = urls(spark, *[(i, f"u{i}", "a", True, 1) for i in (1, 2, 3)])
    status = spark.createDataFrame([(i,) for i in ids], "url_id long")
    found = selection.never_checked(url, status, active(spark, 1, 2, 3))
    assert sorted(r.id for r in found.collect()) == wanted
    url.createOrReplaceTempView("u")
    status.createOrReplaceTempView("s")
    assert sorted(r.id for r in spark.sql("SELECT id FROM u WHERE id NOT IN (SELECT url_id FROM s)").collect()) == wanted


def test_sql_source_must_return_id_and_name(spark):
    url = urls(spark, (1, "u1", "a", True, 1))
    assert selection.select_sql(spark, "SELECT name, id, 1 AS x FROM {url} WHERE id = :i", {"i": 1}, url=url).collect() == [(1, "u1")]
    with pytest.raises(ValueError, match="name"):
        selection.select_sql(spark, "SELECT id FROM {url}", url=url)


def test_selection_plan_trims_before_the_shuffle_and_prunes(spark):
    folder = "/root/testdata/sf0.001"
    plan = queries.due_urls(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "TakeOrderedAndProject" in plan and "LeftSemi" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert any("l_orderkey:bigint,l_returnflag:string>" in line for line in scans)
    assert all("o_totalprice" not in line for line in scans)
    unchecked = queries.unchecked_count(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in unchecked and "NestedLoop" not in unchecked


def test_in_flight_is_matched_by_name(spark):
    selected = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    busy = spark.createDataFrame([("b",), ("b",), ("1",)], "name string")
    assert [r.id for r in selection.exclude_in_flight(selected, busy).collect()] == [1]


def test_registers_fit_their_schemas(spark):
    folder = "/root/testdata/sf0.001"
    for found, layout in (
        (projections.url(spark, folder), schema.URL),
        (projections.full_status(spark, folder), schema.STATUS),
        (projections.url_context(spark, folder), schema.URL_CONTEXT),
        (projections.responses(spark, folder), schema.RESPONSES),
    ):
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in layout]
