from datetime import date, timedelta


from weeksignal.functions import weeks


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr).first()[0]


def test_iso_week_cases(spark):
    cases = {
        "2024-12-30": "2025-W01", "2021-01-03": "2020-W53", "2026-01-01": "2026-W01",
        "2024-12-30T10:00:00Z": "2025-W01", "2024": "", "garbage": "", "2024-02-30": "", "": "", "2024-1-5": "2024-W01",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "d string")
    got = {r.d: r.w for r in df.select("d", weeks.iso_week("d").alias("w")).collect()}
    assert got == {**cases, None: ""}


def test_parse_and_offset(spark):
    df = spark.createDataFrame([("2024-W12",), ("2020-W53",), ("bad",), ("2021-W53",), ("2024-W00",)], "w string")
    rows = df.select(
        "w", weeks.parse_week("w").alias("d"), weeks.week_offset("w", 1).alias("n"), weeks.valid_week("w").alias("v")
    ).collect()
    got = {r.w: (r.d, r.n, r.v) for r in rows}
    assert got["2024-W12"] == (date(2024, 3, 18), "2024-W13", True)
    assert got["2020-W53"][1] == "2021-W01"
    assert got["bad"] == (None, "", False)
    assert got["2021-W53"][:2] == (None, "")
    assert got["2024-W00"][0] is None


def test_week_numbers_follow_the_calendar(spark):
    days = [date(1969, 12, 1) + timedelta(days=5 * i) for i in range(6000)]
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "d string")
    rows = df.withColumn("w", weeks.iso_week("d")).withColumn("n", weeks.week_number("w")).collect()
    for r in rows:
        iso = date.fromisoformat(r.d).isocalendar()
        assert r.w == f"{iso[0]}-W{iso[1]:02d}"
        monday = date.fromisocalendar(iso[0], iso[1], 1)
        assert r.n == (monday - date(1970, 1, 5)).days // 7


def test_epochs(spark):
    df = spark.createDataFrame([(1_700_000_000.0,), (0.0,), (86_399.9,)], "s double")
    rows = df.select(weeks.epoch_to_date("s").alias("d")).collect()
    assert [r.d for r in rows] == ["2023-11-14", "1970-01-01", "1970-01-01"]
    assert one(spark, weeks.date_to_epoch("d"), d="2023-11-14") == 1_699_920_000


def test_weeks_between(spark):
    assert one(spark, weeks.weeks_between("a", "b"), a="2021-W01", b="2020-W52") == 2
