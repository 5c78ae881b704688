from datetime import date, timedelta

import pytest

from tierline.plans.date_dim import date_dim, load_date_dim


def test_calendar_against_the_standard_library(spark):
    got = [tuple(r) for r in date_dim(spark).orderBy("date").collect()]
    quarter = {m: q for q, months in ((1, (3, 4, 5)), (2, (6, 7, 8)), (3, (9, 10, 11)), (4, (12, 1, 2)))
               for m in months}
    days = [date(2022, 1, 1) + timedelta(i) for i in range(1461)]
    assert got == [(d, d.year, d.month, d.day, d.isoweekday() % 7 + 1, d.isocalendar()[1], quarter[d.month])
                   for d in days]


def test_types(spark):
    assert [t for _, t in date_dim(spark).dtypes] == ["date"] + ["int"] * 6


@pytest.mark.parametrize("end", ["2022-01-01", "2021-12-31"])
def test_end_after_start(spark, end):
    with pytest.raises(ValueError, match="End date must be after start date."):
        date_dim(spark, "2022-01-01", end)


def test_stored(spark, tmp_path, capsys):
    load_date_dim(spark, str(tmp_path), "2024-02-27", "2024-03-02")
    target = load_date_dim(spark, str(tmp_path), "2024-02-28", "2024-03-01", preview=True)
    assert [r.quarter for r in target.read().orderBy("date").collect()] == [4, 4, 1]
    assert "day_of_week" in capsys.readouterr().out
