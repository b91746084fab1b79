"""Cases that must fail or must not multiply."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from quartzo.functions.columns import money_sum
from quartzo.operators.changes import upsert
from quartzo.plans import gold, validate
from quartzo.sources import formats
from quartzo.sources.control import Control

DAY = datetime.date(2024, 1, 1)


def test_upsert_gives_each_key_once(spark, rows):
    schema = "id int, seq int, v string"
    base = spark.createDataFrame([(1, None, "old"), (2, 5, "old"), (3, 5, "old"), (4, None, "old"), (5, 2, "old"), (None, 1, "old")], schema)
    changes = spark.createDataFrame([(1, 5, "new"), (2, None, "new"), (3, 5, "new"), (4, None, "new"), (5, 1, "new"), (6, None, "new"), (5, 0, "older"), (None, 2, "new")], schema)
    got = upsert(base, changes, ["id"], "seq")
    assert rows(got.select("id", "v")) == sorted(
        [(1, "new"), (2, "old"), (3, "new"), (4, "new"), (5, "old"), (6, "new"), (None, "new")], key=lambda t: tuple((x is not None, str(x)) for x in t)
    )


def test_money_beyond_16_digits_of_cents(spark):
    df = spark.range(200).select(F.lit(1e12).alias("v"))
    assert df.agg(money_sum("v").alias("s")).first().s == Decimal("200000000000000.00")
    assert spark.range(300).select(F.lit(3e13).alias("v")).agg(money_sum("v").alias("s")).first().s == Decimal("9000000000000000.00")


def tables(spark, event_day=DAY):
    key = gold.dim_date((spark.createDataFrame([(DAY,)], "d date"), "d"))
    sk = lambda d: d.year * 10000 + d.month * 100 + d.day
    one = lambda name: spark.createDataFrame([(1,)], f"{name} long")
    fact = spark.createDataFrame([(sk(DAY), 1, 1)], "sk_data int, sk_cliente long, sk_produto long")
    return {
        "dim_data": key, "dim_cliente": one("sk_cliente"), "dim_produto": one("sk_produto"), "dim_campanha": one("sk_campanha"),
        "fato_vendas": fact, "fato_eventos": fact.withColumn("sk_data", F.lit(sk(event_day))), "fato_entregas": fact.select("sk_data"),
    }


def test_a_fact_day_without_a_date_is_an_orphan(spark):
    good, bad = (validate.no_orphan_keys(validate.links(tables(spark, d))).first() for d in (DAY, datetime.date(2024, 2, 2)))
    assert good.ok and not bad.ok and bad.detalhe.startswith("1 ")


def test_a_repeated_campaign_key_is_found(spark):
    t = tables(spark)
    check = lambda: validate.dim_keys_unique({n: (t[f"dim_{n}"], k) for n, k in validate.DIMENSIONS.items()}).first().ok
    assert check()
    t["dim_campanha"] = t["dim_campanha"].union(t["dim_campanha"])
    assert not check()


def test_calendar_covers_all_facts(spark):
    day = lambda *ds: (spark.createDataFrame([(d,) for d in ds], "d date"), "d")
    got = gold.dim_date(day(DAY), day(datetime.date(2023, 12, 30), None), day())
    assert [r.sk_data for r in got.orderBy("data").collect()] == [20231230, 20231231, 20240101]


def test_a_full_rebuild_forgets_a_day_and_a_partial_one_keeps_it(spark, tmp_path):
    both = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, day string")
    for full, days in ((True, {"2024-01-01"}), (False, {"2024-01-01", "2024-01-02"})):
        path = str(tmp_path / str(full))
        formats.write_partitioned(both, path, ["day"])
        formats.write_partitioned(both.filter("v = 1"), path, ["day"], full=full)
        assert {str(r.day) for r in spark.read.parquet(path).collect()} == days


def test_marks_compare_by_their_kind(spark, tmp_path):
    control = Control(spark, str(tmp_path / "marks"))
    for mark in ("9", "10"):
        control.advance("t", mark)
    assert control.watermark("t", "0", "bigint") == "10" and control.watermark("other", "0", "bigint") == "0"
