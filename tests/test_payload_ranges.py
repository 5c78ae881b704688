import json
import random

import pytest
from pyspark.sql import DataFrameWriter

from tierline.queries import QUERIES
from tierline.sources import payload_ranges
from tierline.sources.landing import land_payload, read_json


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of some tens of bytes, so every kind of cut occurs."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")
    yield use
    for name, value in before.items():
        spark.conf.set(name, value) if value else spark.conf.unset(name)


def written(path, *texts):
    path.mkdir()
    for i, text in enumerate(texts):
        (path / f"{i}.json").write_text(text, encoding="utf-8")
    return str(path)


def cut(spark, path, *tables):
    return sorted((r.name, json.dumps(json.loads(r.value), sort_keys=True))
                  for r in payload_ranges.cut_documents(spark, path, tables).collect())


def expected(documents, *tables):
    return sorted((t, json.dumps(row, sort_keys=True)) for d in documents for t in tables for row in d["data"][t])


def odd_text(rng):
    return "".join(rng.choices(['"', "\\", "{", "}", "[", "]", ":", ",", "a", " ", "\n", "é", "漢", "data"], k=rng.randint(0, 12)))


def document(rng, rows):
    def value(deep=0):
        kind = rng.randrange(6 if deep < 3 else 3)
        if kind == 3:
            return [value(deep + 1) for _ in range(rng.randrange(3))]
        if kind == 4:
            return {odd_text(rng): value(deep + 1) for _ in range(rng.randrange(3))}
        return (odd_text(rng), rng.randint(-9, 9), None)[kind] if kind < 3 else {}

    def row():
        return {odd_text(rng): value() for _ in range(rng.randrange(5))}
    data = {"a": [row() for _ in range(rows)], "other": [1, "x", {"b": []}], "b": [], "c": [row() for _ in range(rows // 2)]}
    return {"status": {"a": [{"no": {"row": 1}}], "deep": [[[{}]]]}, "data": data, "after": {"c": [{"x": 1}]}}


@pytest.mark.parametrize("size", [120, 700, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_rows_of_odd_documents(spark, tmp_path, small_ranges, size, indent):
    rng = random.Random(f"{size} {indent}")
    rows = 8 if size < 200 else 40
    documents = [document(rng, rows), document(rng, 3)]
    path = written(tmp_path / "d", *(json.dumps(d, indent=indent, ensure_ascii=rng.random() < 0.5) + rng.choice(["", "\n", " \n"])
                                     for d in documents))
    small_ranges(size)
    if size < 200:
        assert spark.read.text(path, lineSep="}").rdd.getNumPartitions() > 4
    assert cut(spark, path, "a", "b", "c") == expected(documents, "a", "b", "c")


def test_several_documents_in_a_file(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    documents = [document(rng, 4) for _ in range(5)]
    path = written(tmp_path / "d", "\n".join(map(json.dumps, documents)))
    small_ranges(300)
    assert cut(spark, path, "a", "c") == expected(documents, "a", "c")


def test_a_row_over_many_ranges(spark, tmp_path, small_ranges):
    big = {"id": 1, "list": [{"n": i, "s": "}{"} for i in range(300)]}
    documents = [{"data": {"t": [{"id": 0}, big, {"id": 2}]}}]
    path = written(tmp_path / "d", json.dumps(documents[0]))
    small_ranges(500)
    assert cut(spark, path, "t") == expected(documents, "t")


def test_line_breaks_are_cut_out_between_values_only(spark, tmp_path):
    path = written(tmp_path / "d", json.dumps({"data": {"t": [{"a": "x\ny", "b": 2}]}}, indent=4))
    (row,) = payload_ranges.cut_documents(spark, path, ("t",)).collect()
    assert "\n" not in row.value and json.loads(row.value) == {"a": "x\ny", "b": 2}


@pytest.mark.parametrize("data, error, words", [
    ({"t": [{"a": 1}, 5]}, TypeError, "no rows"), ({"t": ["x"]}, TypeError, "no rows"), ({"t": [[{"a": 1}]]}, TypeError, "no rows"),
    ({"t": {"a": 1}}, TypeError, "no list"), ({"t": "[{}]"}, TypeError, "no list"), ({"u": [{"a": 1}]}, KeyError, "no table 't'"),
    ({"a}b": [{"a": 1}], "t": []}, TypeError, "closing brace")])
def test_what_is_refused(spark, tmp_path, small_ranges, data, error, words):
    small_ranges(3)
    with pytest.raises(error, match=words):
        payload_ranges.cut_documents(spark, written(tmp_path / "d", json.dumps({"data": data})), ("t",)).collect()


def test_other_tables_need_not_be_lists_of_rows(spark, tmp_path):
    path = written(tmp_path / "d", json.dumps({"data": {"s": "text", "t": [{"a": 1}], "n": [1, 2]}}))
    assert cut(spark, path, "t") == [("t", '{"a": 1}')]


def test_landed_by_many_tasks_of_one_file(spark, tmp_path, small_ranges, rows):
    lines = [{"id": i, "date": f"2024-01-{i % 28 + 1:02d}", "note": "}" * (i % 5)} for i in range(500)]
    path = written(tmp_path / "d", json.dumps({"data": {"sales": lines, "none": []}}))
    small_ranges(2000)
    land_payload(spark, path, f"{tmp_path}/landing", "facts", ("sales", "none"), by_ranges=True, window=("2024-01-03", "2024-01-05"))
    landed = read_json(spark, f"{tmp_path}/landing/facts/sales.json")
    assert rows(landed, "id", "note") == sorted(((d["id"], d["note"]) for d in lines if "03" <= d["date"][-2:] <= "05"), key=str)
    assert spark.read.text(f"{tmp_path}/landing/facts/none.json").count() == 0
    # Several tasks read the one file.
    assert payload_ranges._segments(spark, path).rdd.getNumPartitions() > 5
    with pytest.raises(ValueError, match="without a date"):
        land_payload(spark, written(tmp_path / "e", json.dumps({"data": {"sales": [{"id": 1}]}})), f"{tmp_path}/landing", "facts",
                     ("sales",), by_ranges=True, window=("2024-01-03", "2024-01-05"))


def tables(spark, folder, orders, customers):
    """The columns that the query of the huge document reads, in several files each."""
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_totalprice double").repartition(3).write.parquet(
        f"{folder}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_acctbal double").repartition(2).write.parquet(
        f"{folder}/customer.parquet")
    return str(folder)


@pytest.mark.parametrize("n", [0, 1, 400])
def test_the_huge_document_is_one_file_and_no_task_holds_it(spark, tmp_path, small_ranges, monkeypatch, n):
    """Keys repeat and are null; what builds the file neither shuffles nor sorts nor windows the rows."""
    orders = [(None if i % 50 == 7 else i // 2, "}, {" if i % 3 else None, i / 2) for i in range(n)]
    customers = [(None if i % 9 == 5 else i % 20, f"c{i}", -float(i)) for i in range(n // 4)]
    plans = {}
    for kind in ("text", "parquet"):
        def write(writer, path, *args, known=getattr(DataFrameWriter, kind), **kwargs):
            if "/document-" in path and "/landing/" not in path:
                plans[path] = writer._df._jdf.queryExecution().executedPlan().toString()
            return known(writer, path, *args, **kwargs)
        monkeypatch.setattr(DataFrameWriter, kind, write)
    small_ranges(2000)
    found = QUERIES["payload_huge_document"](spark, tables(spark, tmp_path, orders, customers))
    expected = [("orders", *r) for r in orders] + [("customer", k, name + '}, {"', x) for k, name, x in customers]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    (path,) = [p for p in plans if p.endswith("/document")]
    whole = spark.read.text(path, wholetext=True).collect()
    assert len(whole) == 1
    assert {k: len(v) for k, v in json.loads(whole[0].value)["data"].items()} == {
        "orders": len(orders), "empty": 0, "customer": len(customers)}
    for text in plans.values():
        assert not any(word in text for word in ("Exchange", "Sort", "Window")), text
