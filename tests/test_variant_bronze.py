import json

import pytest

from tierline import files
from tierline.sources import variant_bronze
from tierline.sources.bronze import read_bronze
from tierline.sources.landing import CORRUPT, read_json

LINES = [{"a": 1, "b": 1.5, "c": {"k": "x", "l": [1, 2]}, "d": None, "e": True, "m": 1, "odd name`s, x: OBJECT<": 3},
         {"a": 12345678901, "b": 2, "c": {"k": None}, "e": False, "f": "2024-01-01", "g": 1e30, "m": "text", "o": {}},
         {"a": None, "c": {"l": []}, "n": [{"x": 1}, {"y": 2.5}]}]


def land(folder, name, lines):
    path = folder / "landing" / "facts"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(f"{x if isinstance(x, str) else json.dumps(x)}\n" for x in lines))
    return f"{folder}/landing"


def test_types_and_rows_are_those_of_inference(spark, tmp_path):
    landing = land(tmp_path, "t.json", LINES)
    inferred = read_json(spark, f"{landing}/facts/t.json")
    kinds = variant_bronze.landing_to_typed(spark, landing, f"{tmp_path}/bronze", 5)
    ours = read_bronze(spark, f"{tmp_path}/bronze", 5, "t")
    assert sorted(ours.dtypes) == sorted(t for t in inferred.dtypes if t[0] != "o") and set(kinds) == {"t"}
    plain = lambda df: sorted(str(sorted((k, str(v)) for k, v in r.asDict(True).items() if k != "o"))
                              for r in df.collect())
    assert plain(ours) == plain(inferred)


def test_the_landed_files_are_read_once(spark, tmp_path):
    landing = land(tmp_path, "t.json", LINES)
    variant_bronze.stage(variant_bronze.scan_lines(spark, landing), f"{tmp_path}/bronze", 5)
    files.delete(spark, landing)
    variant_bronze.settle(spark, f"{tmp_path}/bronze", 5)
    assert read_bronze(spark, f"{tmp_path}/bronze", 5, "t").count() == 3


def test_arrays_blank_and_corrupt_lines(spark, tmp_path, rows):
    landing = land(tmp_path, "t.json", ['[{"a": 1}, {"a": 2}]', "", "  ", "no json", "5", '{"a": 3}', '{"a": 1, "a": 2}'])
    variant_bronze.landing_to_typed(spark, landing, f"{tmp_path}/bronze", 5)
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "t")) == [(1,), (2,), (3,)]
    corrupt = spark.read.option("columnNameOfCorruptRecord", "_other").json(f"{tmp_path}/bronze/corrupt/5/t/5")
    assert rows(corrupt, CORRUPT) == [("5",), ("no json",), ('{"a": 1, "a": 2}',)]


def test_whole_files_and_several_tables(spark, tmp_path, rows):
    landing = land(tmp_path, "t.json", [json.dumps([{"a": 1}, {"a": 2}], indent=2)])
    land(tmp_path, "u.v.json", [json.dumps({"b": "x"}, indent=2)])
    variant_bronze.landing_to_typed(spark, landing, f"{tmp_path}/bronze", 5, whole_files=True)
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "t")) == [(1,), (2,)]
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "u")) == [("x",)]


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    assert variant_bronze.settle(spark, f"{tmp_path}/bronze", 5) == {}
    land(tmp_path, "t.json", [])
    assert variant_bronze.landing_to_typed(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", 5) == {}


def run(spark, tmp_path, max_files=1):
    variant_bronze.start_landing_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", 5, f"{tmp_path}/checkpoint",
                                        max_files).awaitTermination()


def test_stream_takes_what_is_new_and_merges_types(spark, tmp_path, rows):
    land(tmp_path, "t.json", [{"a": 1}])
    land(tmp_path, "u.json", [{"z": "x"}])
    run(spark, tmp_path)
    variant_bronze.settle(spark, f"{tmp_path}/bronze", 5)
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "t")) == [(1,)]
    run(spark, tmp_path)  # nothing new
    land(tmp_path, "t.more.json", [{"a": 2.5, "b": "new"}])
    run(spark, tmp_path)
    kinds = variant_bronze.settle(spark, f"{tmp_path}/bronze", 5)
    assert kinds["t"].simpleString() == "struct<a:double,b:string>"
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "t")) == [(1.0, None), (2.5, "new")]
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "u")) == [("x",)]


def test_an_interrupted_batch_comes_again_and_replaces_itself(spark, tmp_path, rows, monkeypatch):
    for i in range(4):
        land(tmp_path, f"t.{i}.json", [{"a": 10 * i + k} for k in range(3)])
    whole, calls = variant_bronze.stage, []

    def broken(*args):
        whole(*args)
        calls.append(args[-1])
        if len(calls) == 2:
            raise RuntimeError("lost after its rows were written")
    monkeypatch.setattr(variant_bronze, "stage", broken)
    with pytest.raises(Exception, match="lost after its rows"):
        run(spark, tmp_path)
    run(spark, tmp_path)
    assert calls == [0, 1, 1, 2, 3]
    variant_bronze.settle(spark, f"{tmp_path}/bronze", 5)
    assert rows(read_bronze(spark, f"{tmp_path}/bronze", 5, "t")) == sorted(((10 * i + k,) for i in range(4) for k in range(3)), key=str)
