import json

from tierline.__main__ import main
from tierline.sources.snapshots import SnapshotTable
from test_jobs import documents


def test_jobs_one_by_one(spark, tmp_path):
    base = ["--base", f"{tmp_path}/lake"]
    dims, facts = documents(tmp_path, "x", "2023-01-01", 5)
    day = ["--input-date", "2023-01-01"]
    assert main([*base, "gate", "--run-id", "1", "--producer", "ingest-lambda"]) == 1
    assert main([*base, "ingest", "--run-id", "1", "--dimension-documents", dims,
                 "--fact-documents", facts, *day]) == 0
    assert main([*base, "gate", "--run-id", "1", "--producer", "ingest-lambda"]) == 0
    assert main([*base, "bronze", "--run-id", "1"]) == 0
    assert main([*base, "silver", "--run-id", "1", "--load-type", "full_load"]) == 0
    assert main([*base, "gold", "--start", "2024-01-01", "--end", "2024-01-31"]) == 0
    assert SnapshotTable(spark, f"{tmp_path}/lake/gold/dim_date").read().count() == 31
    assert SnapshotTable(spark, f"{tmp_path}/lake/silver/sales_data").read().count() == 1


def test_own_mapping_file(spark, tmp_path):
    mapping = tmp_path / "mapping.csv"
    mapping.write_text(
        "source_table,source_column,target_column,cast_to,na_default,is_generated,transformation,expr,dq_rule\n"
        "things,NA,dwid,integer,NA,Y,EXPR,id,NA\nthings,id,id,integer,0,N,NA,NA,NA\n")
    folder = tmp_path / "lake/landing"
    folder.mkdir(parents=True)
    folder.joinpath("things.json").write_text(json.dumps([{"id": 4}, {"id": 4}, {"id": 5}]))
    base = ["--base", f"{tmp_path}/lake"]
    assert main([*base, "bronze", "--run-id", "2"]) == 0
    assert main([*base, "silver", "--run-id", "2", "--mapping", str(mapping)]) == 0
    assert SnapshotTable(spark, f"{tmp_path}/lake/silver/things").read().count() == 2
    assert main([*base, "silver", "--run-id", "3", "--mapping", str(mapping)]) == 1
