from __future__ import annotations

import pytest

from kilowise.plans import procedures, sql_surface
from kilowise.plans.bindings import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql(spark):
    sql_surface.create_views(Tables(spark, FOLDER))
    sql_surface.create_functions(spark)
    return spark.sql


def test_scalar_functions(sql):
    assert sql("SELECT mask_email('a.b@c.d')").first()[0] == "****@****"
    assert float(sql("SELECT calculate_charge('Commercial', 10)").first()[0]) == 1.5
    assert float(sql("SELECT calculate_charge('Residential', 10)").first()[0]) == 1.0
    assert sql("SELECT is_evening_peak(TIMESTAMP '2023-01-01 17:00:00')").first()[0]
    with pytest.raises(Exception, match="Unknown tariff type"):
        sql("SELECT calculate_charge('Industrial', 10)").collect()


def test_table_functions(sql, spark):
    all_regions = sql("SELECT * FROM calculate_monthly_billing(DATE '1998-06-15')")
    one = sql("SELECT * FROM calculate_monthly_billing(DATE '1998-06-15', 'ASIA')")
    assert 0 < one.count() < all_regions.count()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = all_regions._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01" in plan
    assert sql("SELECT * FROM get_customers_by_region('EUROPE')").count() > 0


def test_recursive_forms_agree(sql, spark):
    from kilowise.operators.fleet import meter_hierarchy

    found = sql("SELECT descendant_id, distance FROM meter_descendants(0)").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, meter_hierarchy(Tables(spark, FOLDER).meters).collect()))
    powers = "WITH RECURSIVE powers(p) AS (VALUES (3) UNION ALL SELECT 3 * p FROM powers WHERE p < 200) SELECT p FROM powers"
    assert [r["p"] for r in sql(powers).collect()] == [3, 9, 27, 81, 243]


@pytest.fixture
def tree(spark):
    """Meters as a tree deeper than Spark's recursion limit, a circle with a tail, and one whose parent is missing."""
    chain = [(i, i - 1 if i else None) for i in range(104)] + [(1000 + i, i // 2) for i in range(40)]
    circle = [(2000, 2002), (2001, 2000), (2002, 2001), (2003, 2001), (3000, 2999), (4000, 4000)]
    rows = spark.createDataFrame(chain + circle, "meter_id long, parent_meter_id long")
    old = spark.table("dim_meter")
    rows.createOrReplaceTempView("dim_meter")
    yield rows
    old.createOrReplaceTempView("dim_meter")


def test_descendants_in_a_deep_tree_and_in_a_circle(sql, tree):
    from kilowise.operators.fleet import meter_hierarchy

    assert sorted(map(tuple, sql("SELECT descendant_id, distance FROM meter_descendants(0)").collect())) == sorted(map(tuple, meter_hierarchy(tree).collect()))
    below = lambda top: sorted(tuple(r) for r in sql(f"SELECT descendant_id, distance FROM meter_descendants({top})").collect())
    assert below(2000) == [(2000, 0), (2001, 1), (2002, 2), (2003, 2)] and below(2003) == [(2003, 0)]
    assert below(3000) == [(3000, 0)] and below(4000) == [(4000, 0)] and not below(99999)
    children = {}
    for r in tree.collect():
        children.setdefault(r["parent_meter_id"], []).append(r["meter_id"])
    whole = sql("SELECT meter_id, count(*) AS n FROM meter_descendants() GROUP BY meter_id").collect()

    def reach(top):
        seen, queue = {top}, [top]
        while queue:
            new = [c for c in children.get(queue.pop(), []) if c not in seen]
            seen |= set(new)
            queue += new
        return len(seen)

    assert {r["meter_id"]: r["n"] for r in whole} == {r["meter_id"]: reach(r["meter_id"]) for r in tree.collect()}


def test_no_level_broadcasts_the_meters(sql, spark):
    # A broadcast is collected by the driver: one of all meters per level.
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    try:
        assert sql("SELECT count(*) FROM meter_descendants(0)").first()[0] == spark.table("dim_meter").count()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_regions_are_data(sql, spark):
    regions = ["ASIA", "O'Brien's", "x') OR ('1' = '1", ":region_0", 'a "b"', "\\'"]
    found = sql_surface.readings_of_regions(spark, regions)
    assert {r["region"] for r in found.select("region").distinct().collect()} == {"ASIA"}
    assert sql_surface.readings_of_regions(spark, []).count() == 0
    named = spark.createDataFrame([(r, i) for i, r in enumerate(regions)] + [("b", 9)], "region string, reading_id int")
    old = spark.table("fact_meter_readings")
    named.createOrReplaceTempView("fact_meter_readings")
    try:
        assert sql_surface.readings_of_regions(spark, regions).count() == len(regions)
    finally:
        old.createOrReplaceTempView("fact_meter_readings")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = sql_surface.readings_of_regions(spark, ["ASIA", "AFRICA"])._jdf.queryExecution().executedPlan().toString()
    assert "In(r_name, [AFRICA,ASIA])" in plan or "In(r_name, [ASIA,AFRICA])" in plan


def test_a_failing_call_leaves_the_table_and_a_log(sql, spark, tmp_path):
    target, log = str(tmp_path / "customers"), str(tmp_path / "log")
    address = sql("SELECT min(office_address) FROM dim_customer").first()[0]
    call = lambda email, at=address: procedures.call(spark, "log_and_update", {"address": at, "email": email}, target, log)
    assert call("a@b") is True
    emails = lambda: {r["email"] for r in procedures.read_result(spark, target).filter(f"office_address = '{address}'").collect()}
    assert emails() == {"a@b"} and call("no mail, O'Brien") is False and emails() == {"a@b"}
    assert [(r["name"], r["address"], r["email"]) for r in spark.read.parquet(log).collect()] == [("log_and_update", address, "no mail, O'Brien")]
    assert call("c@d", "nowhere") is True and spark.read.parquet(target).count() == sql("SELECT count(*) FROM dim_customer").first()[0]
    assert emails() != {"a@b"}  # the bound table is what a call starts from
    with pytest.raises(ValueError):
        procedures.call(spark, "log_and_update", {"address": address, "email": "a@b"}, target, str(tmp_path / "it's"))
    with pytest.raises(KeyError):
        procedures.call(spark, "no_such_procedure", {}, target)


def test_an_error_without_handler_is_raised(sql, spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        procedures.call(spark, "generate_monthly_bills", {"month": "no date"}, str(tmp_path / "bills"))
    assert not (tmp_path / "bills").exists()


def test_meter_states(sql, spark):
    """Limits themselves are healthy; a meter whose readings have no usage too."""
    rows = [(1, "2024-01-10", 1.0), (2, "2024-01-02", 1.0), (3, "2024-01-03", 50 / 24), (4, "2024-01-10", 0.02), (5, "2024-01-10", 3.0), (6, "2024-01-10", None), (8, "2023-01-10", None)]
    spark.createDataFrame(rows, "meter_id long, reading_ts string, kwh_usage double").selectExpr("meter_id", "CAST(reading_ts AS TIMESTAMP) AS reading_ts", "kwh_usage").createOrReplaceTempView("_r")
    old = {name: spark.table(name) for name in ("dim_meter", "fact_meter_readings")}
    spark.table("_r").createOrReplaceTempView("fact_meter_readings")
    spark.range(1, 10).selectExpr("id AS meter_id", "id AS customer_id", "id <> 9 AS is_active").createOrReplaceTempView("dim_meter")
    try:
        found = {r["meter_id"]: r["health_status"] for r in sql("SELECT * FROM check_meter_health(DATE '2024-01-10')").collect()}
    finally:
        for name, frame in old.items():
            frame.createOrReplaceTempView(name)
    assert found == {1: "HEALTHY", 2: "INACTIVE", 3: "HEALTHY", 4: "LOW_USAGE", 5: "HIGH_USAGE", 6: "HEALTHY", 7: "NO_READINGS", 8: "INACTIVE"}


def test_estimated_bill_reads_one_month(sql, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = sql("SELECT calculate_estimated_bill(customer_id, DATE '1998-06-15') FROM dim_customer")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01" in plan and "LessThan(l_shipdate,1998-07-01" in plan


def test_calendar_opens_the_months_it_names(spark, tmp_path):
    """The scan of the stored readings reads the folders of the quarter only."""
    from kilowise.plans import storage

    path = str(tmp_path / "months")
    rows = spark.sql("SELECT explode(sequence(TIMESTAMP '2023-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS reading_ts, 1L AS customer_id, 2 AS kwh_usage")
    storage.monthly_partitions(rows, path).collect()
    days = spark.sql("SELECT DISTINCT date_format(d, 'yyyy-MM') AS year_month, quarter(d) AS quarter, year(d) AS year FROM (SELECT explode(sequence(DATE '2023-01-01', DATE '2024-12-31')) AS d)")
    days.write.parquet(str(tmp_path / "calendar"))
    calendar = spark.read.parquet(str(tmp_path / "calendar")).filter("quarter = 2 AND year = 2024")
    found = storage.read_calendar_months(spark, path, calendar)
    plan = found._jdf.queryExecution()
    assert "dynamicpruning" in plan.executedPlan().toString()
    counted = found.groupBy("year_month").count()
    assert {r[0]: r[1] for r in counted.collect()} == {"2024-04": 30, "2024-05": 31, "2024-06": 30}
    leaves = counted._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
    opened = []
    for i in range(leaves.size()):
        node = leaves.apply(i)
        for leaf in [node, *([node.plan()] if "QueryStage" in node.getClass().getName() else [])]:
            opened += scans(leaf)
    assert 3 in opened and 24 not in opened


def scans(plan):
    """Numbers of partitions that the file scans below a physical plan have read."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        metrics = node.metrics()
        if metrics.contains("numPartitions"):
            found.append(metrics.apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_sql_billing_agrees_with_the_job_on_null_flags(sql, spark):
    """A reading without a peak flag is in the total, but in neither part."""
    from pyspark.sql import functions as F

    from kilowise.operators.billing import monthly_billing

    x = Tables(spark, FOLDER)
    half = x.readings.withColumn("is_peak_hours", F.when(F.col("reading_id") % 2 == 0, F.col("is_peak_hours")))
    half.createOrReplaceTempView("fact_meter_readings")
    try:
        found = sorted(map(tuple, sql("SELECT * FROM calculate_monthly_billing(DATE '1998-06-01')").collect()))
    finally:
        x.readings.createOrReplaceTempView("fact_meter_readings")
    columns = ["customer_id", "billing_month", "total_kwh", "peak_kwh", "offpeak_kwh", "amount_due"]
    want = sorted(map(tuple, monthly_billing(half, x.customers, x.tariffs, "1998-06-01").select(columns).collect()))
    assert found == want and any(r[2] != r[3] + r[4] for r in found)
