import json
import time

import pytest
from pyspark.sql import functions as F

from tierline.mapping import CUSTOM, ColumnRule, identity_key, integer, string, table
from tierline.operators import runlog
from tierline.plans import dairy, jobs
from tierline.plans.parameters import FULL_LOAD, INCREMENTAL_LOAD, RunParameters
from tierline.sources.bronze import write_bronze
from tierline.sources.snapshots import SnapshotTable

AS_OF = "2024-05-01 06:00:00"


def farmer(n, **other):
    return {"farmer_id": n, "name": f"N{n}", "gender": "F", "phone": 910000000000 + n, "col_id": 1,
            "cattle_capacity": 3, "aadhar": 1, "pan": "P", "bank_ac": 9, **other}


DIMENSIONS = {
    "farmers_data": [farmer(1), farmer(1), farmer(2, gender=None), farmer(3, cattle_capacity=1), farmer(4, extra=[1])],
    "collection_center_data": [{"col_id": 1, "chl_id": 2, "owner": "o", "location": None, "phone": 1, "aadhar": 1,
                                "pan": "p", "bank_ac": 1}],
    "chilling_center_data": [{"chl_id": 2, "owner": "o", "location": "l", "phone": 1, "aadhar": 12, "pan": "p",
                              "bank_ac": 1}],
    "logistics_contractor_data": [{"contractor_id": 1, "owner": "o", "vehicle_no": "v", "phone": 1, "aadhar": "a",
                                   "pan": "p", "bank_ac": 1}],
    "routes_data": [{"route_id": "R1", "stops": "a,b", "distance": 12.9, "cost": "17.5"}],
    "distributor_data": [{"distributor_id": 1, "name": "n", "phone": 1, "area": "a"}],
    "products_data": [{"product_id": 1, "name": "n", "price": 5, "sl": "3 days", "recipe_id": "A"}],
    "recipe_data": [{"recipe_id": "A", "raw_material": "milk", "quantity_per_unit_ml": 500}],
}


def facts(day, quantity):
    milk = {"quantity": quantity, "fat": 3.456, "snf": 8.1, "date": day}
    rows = {
        "collection_center_procurement": {"farmer_id": 1, "amount": 99.999, "col_id": 1, **milk},
        "chilling_center_procurement": {"col_id": 1, "qa_check": "ok", "commission": 1.5, "route_id": "R1",
                                        "chl_id": 2, **milk},
        "aggregated_procurement": {"chl_id": 2, "qa_check": None, "route_id": "R1", **milk},
        "daily_logistics": {"route_id": "R1", "contractor_id": 1, "material": "milk", "date": day},
        "production_data": {"batch_no": "B1", "date": day, "product_id": 1, "quantity": quantity},
        "sales_data": {"sales_id": "S1", "date": day, "product_id": 1, "quantity": quantity, "distributor_id": 1,
                       "route_id": "R1"},
    }
    return {name: [row, {**row, "date": "1999-01-01"}] for name, row in rows.items()}


def documents(tmp_path, name, day, quantity):
    dims, fact = tmp_path / f"{name}-dims.json", tmp_path / f"{name}-facts.json"
    dims.write_text(json.dumps({"data": DIMENSIONS}))
    fact.write_text(json.dumps({"data": facts(day, quantity)}, indent=1))
    return str(dims), str(fact)


def test_whole_run_of_all_tables(spark, tmp_path, rows):
    base = f"{tmp_path}/lake"

    def run(run_id, day, quantity, load_type):
        parameters = RunParameters(run_id, day, day, load_type)
        return jobs.run_steps(spark, base, parameters, *documents(tmp_path, str(run_id), day, quantity),
                              database="tierline_dairy")

    spark.sql(f"CREATE DATABASE IF NOT EXISTS tierline_dairy LOCATION '{tmp_path}/db'")
    assert run(1, "2023-01-01", 10, FULL_LOAD)
    assert run(2, "2023-01-02", 20, INCREMENTAL_LOAD)
    assert run(3, "2023-01-02", 30, INCREMENTAL_LOAD)

    read = lambda name: SnapshotTable(spark, f"{base}/silver/{name}").read()
    for name, mapping in dairy.MAPPING.items():
        assert read(name).columns == mapping.insert_columns
    assert rows(read("farmers_data"), "dwid", "farmer_name", "phone", "etl_run_id") == [
        (1, "N1", "0000000001", "3"), (4, "N4", "0000000004", "3")]
    rejected = spark.read.json(f"{base}/dq_failed/farmers_data/2")
    assert rows(rejected, "dwid", "gender", "DataQualityEvaluationResult") == [(2, "_", "Failed"), (3, "F", "Failed")]
    assert rows(read("sales_data"), "dwid", "quantity", "etl_run_id") == [
        ("167253120011", 10, "1"), ("167261760011", 30, "3")]
    assert rows(read("collection_center_procurement").withColumn("amount", F.col("amount").cast("string")),
                "dwid", "amount") == [(16725312001, "100.0"), (16726176001, "100.0")]
    assert rows(read("routes_data"), "distance", "cost") == [(12, 17)]
    assert rows(read("chilling_center_data"), "aadhar") == [("12",)]
    assert rows(read("aggregated_procurement"), "qa_check") == [("_",), ("_",)]
    joined = spark.sql("""SELECT name, sum(quantity) AS sold FROM tierline_dairy.sales_data
                          JOIN tierline_dairy.products_data USING (product_id) GROUP BY name""")
    assert rows(joined) == [("n", 40)]
    log = runlog.RunLog(spark, f"{base}/run_log")
    assert log.table.read().count() == 9
    assert log.lookup(3, runlog.TO_SILVER)["message"].endswith("successfull:ok")


def test_a_failing_step_stops_the_run(spark, tmp_path):
    base = f"{tmp_path}/lake"
    parameters = RunParameters(1, "2023-01-01", "2023-01-01")
    assert jobs.run_steps(spark, base, parameters, f"{tmp_path}/none.json", f"{tmp_path}/none.json") is False
    log = runlog.RunLog(spark, f"{base}/run_log")
    assert log.lookup(1, runlog.INGEST)["status"] == "failed"
    assert log.lookup(1, runlog.TO_BRONZE) is None


def test_bronze_failure_is_reported(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    folder.joinpath("empty.json").write_text("")
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    assert jobs.landing_to_bronze(spark, str(folder), f"{tmp_path}/bronze", 1, log) is False
    assert log.lookup(1, runlog.TO_BRONZE)["status"] == "failed"


def test_one_failing_table_leaves_the_others(spark, tmp_path, rows):
    mapping = {n: table(n, identity_key("id"), integer("id"), string("t")) for n in ("good", "missing", "narrow")}
    write_bronze(spark.createDataFrame([(1, "a")], "id bigint, t string"), f"{tmp_path}/b", 1, "good")
    write_bronze(spark.createDataFrame([(1,)], "id bigint"), f"{tmp_path}/b", 1, "narrow")
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    status, problems = jobs.bronze_to_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", f"{tmp_path}/f", 1,
                                             mapping=mapping, log=log)
    assert status == log.lookup(1, runlog.TO_SILVER)["status"] == "partial"
    assert "table:missing" in problems and "table:narrow" in problems and "table:good" not in problems
    assert rows(SnapshotTable(spark, f"{tmp_path}/s/good").read(), "dwid", "t") == [(1, "a")]


def test_a_table_beyond_its_time_is_cancelled_alone(spark, tmp_path):
    names = [f"t{i}" for i in range(4)]
    for name in names:
        write_bronze(spark.createDataFrame([(1, name)], "id long, name string"), f"{tmp_path}/bronze", 3, name)
    waits = ColumnRule("t2", "NA", "waits", "string", is_generated="Y", transformation=CUSTOM)
    mapping = {n: table(n, identity_key("id"), integer("id"), *([lambda _: waits] if n == "t2" else [])) for n in names}
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    status, problems = jobs.bronze_to_silver(
        spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/bad", 3, mapping=mapping, log=log,
        custom={"t2": {"waits": lambda _: F.expr("reflect('java.lang.Thread', 'sleep', 60000L)")}}, table_seconds={"t2": 1})
    assert status == "partial" and "table:t2" in problems and problems.count("table:") == 1 and "longer than 1 s" in problems
    assert log.lookup(3, runlog.TO_SILVER)["status"] == "partial"
    assert [SnapshotTable(spark, f"{tmp_path}/silver/{n}").exists() for n in names] == [True, True, False, True]
    # The thread is as before, and work within its time is left alone.
    assert not spark.sparkContext.getLocalProperty("spark.job.tags")
    with jobs.time_limit(spark, 60, "short"):
        assert spark.range(3).count() == 3
    with pytest.raises(TimeoutError, match="idle took longer"), jobs.time_limit(spark, 0.1, "idle"):
        time.sleep(0.5)  # no Spark job to cancel


def test_quality_can_be_skipped(spark, tmp_path, caplog):
    mapping = dairy.MAPPING["farmers_data"]
    write_bronze(spark.createDataFrame([farmer(1, gender="X")]), f"{tmp_path}/b", 1, "farmers_data")
    paths = [f"{tmp_path}/{n}" for n in "bsf"]
    caplog.set_level("INFO", logger="tierline")
    checked = jobs.load_silver_table(spark, mapping, *paths, 1, FULL_LOAD, AS_OF)
    assert checked.read().count() == 0
    assert 'farmers_data: ColumnValues "gender" in ["F","M"] Failed, 1 of 1 rows failed' in caplog.messages
    assert jobs.load_silver_table(spark, mapping, *paths, 1, FULL_LOAD, AS_OF,
                                  check_quality=False).read().count() == 1


def test_conflicting_batch_fails_the_table(spark, tmp_path):
    mapping = {"t": table("t", identity_key("id"), integer("id"), string("t"))}
    for run, data in ((1, [(1, "a")]), (2, [(1, "b"), (1, "c")])):
        write_bronze(spark.createDataFrame(data, "id bigint, t string"), f"{tmp_path}/b", run, "t")
        status, problems = jobs.bronze_to_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", f"{tmp_path}/f", run,
                                                 mapping=mapping)
    assert status == "partial" and "dwid values include [1]" in problems


def test_gold(spark, tmp_path):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tierline_gold LOCATION '{tmp_path}/db'")
    assert jobs.silver_to_gold(spark, f"{tmp_path}/gold", log=log, database="tierline_gold")
    assert spark.table("tierline_gold.dim_date").count() == 1461
    assert log.gate(0, runlog.TO_GOLD)
    assert not jobs.silver_to_gold(spark, f"{tmp_path}/gold", 1, log, "2024-01-02", "2024-01-01")
    assert "End date must be after start date." in log.lookup(1, runlog.TO_GOLD)["message"]


def test_mapping_totals():
    rules = [r for m in dairy.MAPPING.values() for r in m.rules]
    kinds = [r.transformation for r in rules]
    assert (len(dairy.MAPPING), len(rules), kinds.count("EXPR"), kinds.count("PHONE")) == (14, 98, 14, 5)
    assert [r.cast_to for r in rules].count("integer") == 48
    assert sum(len(m.dq_rules) for m in dairy.MAPPING.values()) == 2


def test_parameters():
    parameters = RunParameters("5", "2023-1-9", "2023-01-01", backfill="1")
    assert (parameters.run_id, parameters.window) == (5, ("2023-01-01", "2023-01-09"))
    assert RunParameters(5, "2023-01-09", "2023-01-01").window == ("2023-01-09", "2023-01-09")
    for bad in ((None, "2023-01-01", "2023-01-01"), (0, "2023-01-01", "2023-01-01"), (1, None, "2023-01-01"),
                (1, "x", "2023-01-01"), (1, "2023-01-01", "2023-01-01", "other"),
                (1, "2023-01-01", "2023-01-01", FULL_LOAD, "2"), (-1, "2023-01-01", "2023-01-01")):
        with pytest.raises(ValueError):
            RunParameters(*bad)
