"""History by batches and marts by days equal a rebuild from nothing."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from quartzo.plans import gold, refresh
from quartzo.sources import formats
from quartzo.sources.history import History

KINDS = "id bigint, dia date, seg string, n int, seq int"
START = datetime.date(2024, 1, 1)


def changes(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if i % 3 == 0 else rng.randrange(25)
        rows.append((key, START + datetime.timedelta(days=rng.randrange(60)), rng.choice("ab"), rng.choice([None, 1]), i))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_the_rebuilt_rows(spark, tmp_path, rows, seed):
    data = changes(240, seed)
    random.Random(seed).shuffle(data)
    store = History(spark, str(tmp_path / "h"), "id", ["seg", "n"], "dia", KINDS, seq="seq", buckets=8)
    parts = [data[:100], data[100:101], data[101:200], data[200:]]
    for i, part in enumerate(parts):
        touched = store.merge(spark.createDataFrame(part, KINDS), i)
        assert len(touched) == len({r.b for r in spark.createDataFrame(part, KINDS).select(store._bucket().alias("b")).collect()})
        want = store.rebuilt(spark.createDataFrame([r for p in parts[: i + 1] for r in p], KINDS))
        assert rows(store.spans()) == rows(want)
    store.merge(spark.createDataFrame(parts[1], KINDS), 1)  # repeated after a failure
    assert rows(store.spans()) == rows(store.rebuilt(spark.createDataFrame(data, KINDS)))
    assert store.merge(spark.createDataFrame([], KINDS), 9) == []


def test_a_late_change_splits_a_span_where_the_old_value_was_seen_again(spark, tmp_path):
    day = lambda n: START + datetime.timedelta(days=n)
    store = History(spark, str(tmp_path / "h"), "id", ["seg"], "dia", "id bigint, dia date, seg string", buckets=2)
    for batch, row in enumerate([(1, day(0), "a"), (1, day(5), "a"), (1, day(3), "b"), (2, day(1), "x")]):
        store.merge(spark.createDataFrame([row], "id bigint, dia date, seg string"), batch)
    got = sorted((r.id, r.valido_de, r.seg, r.atual) for r in store.spans().collect())
    assert got == [(1, day(0), "a", False), (1, day(3), "b", False), (1, day(5), "a", True), (2, day(1), "x", True)]


def test_a_batch_leaves_other_folders(spark, tmp_path):
    path = str(tmp_path / "h")
    store = History(spark, path, "id", ["seg"], "dia", "id bigint, dia date, seg string", buckets=16)
    store.merge(spark.createDataFrame([(i, START, "a") for i in range(200)], "id bigint, dia date, seg string"), 0)
    files = lambda: {f.path for f in formats.file_sizes(spark, f"{path}/spans").collect()}
    before = files()
    (bucket,) = store.merge(spark.createDataFrame([(3, START + datetime.timedelta(days=9), "b")], "id bigint, dia date, seg string"), 1)
    gone = before - files()
    assert gone and all(f"bucket={bucket}/" in f for f in gone) and store.spans().count() == 201


def test_a_new_day_recomputes_its_cells_only(spark, tmp_path, rows):
    rng, path = random.Random(3), str(tmp_path / "mart")
    dates = gold.dim_date((spark.createDataFrame([(START,), (START + datetime.timedelta(days=45),)], "d date"), "d"))
    keys = sorted(r.sk_data for r in dates.collect())
    sale = lambda i, day: (i, i // 2, keys[day], 1, rng.randrange(5), "web", "paid", "approved", "card", 1, None, rng.randrange(1, 99))
    kinds = "item_id int, order_id int, sk_data int, sk_cliente int, sk_produto int, canal string, status_pedido string, status_pagamento string, metodo_pagamento string, quantidade int, preco_unitario int, valor_bruto decimal(12,2)"
    from decimal import Decimal

    make = lambda rs: spark.createDataFrame([(*r[:-1], Decimal(r[-1])) for r in rs], kinds)
    old = [sale(i, rng.randrange(8)) for i in range(60)] + [(900, 900, keys[2], 1, 9, "web", "paid", "approved", "card", 1, None, 5)]
    new = [r for r in old if r[2] != keys[1]] + [sale(i, 8) for i in range(100, 110)]  # day 1 is emptied, day 8 comes in
    products = spark.createDataFrame([(i, f"c{i % 2}") for i in range(10)], "sk_produto int, categoria string")
    moved = products.withColumn("categoria", F.when(F.col("sk_produto") == 9, "new").otherwise(F.col("categoria")))
    old += [sale(i, 40) for i in range(200, 205)]  # in another month
    new += [r for r in old if r[2] == keys[40]]
    refresh.write_revenue(gold.mart_revenue_by_category_day(make(old), dates, products), path)
    before = {f.path for f in formats.file_sizes(spark, path).collect()}
    changed = refresh.changed_rows(make(old), make(new), ["sk_data"])
    days = refresh.affected_days([make(old), make(new)], changed, refresh.changed_rows(products, moved, ["sk_produto"]))
    assert sorted(r.sk_data for r in days.collect()) == [keys[1], keys[2], keys[8]]
    assert refresh.refresh_revenue(path, make(new), dates, moved, days) == 3
    want = gold.mart_revenue_by_category_day(make(new), dates, moved)
    assert rows(spark.read.parquet(path).select(*want.columns)) == rows(want)
    gone = before - {f.path for f in formats.file_sizes(spark, path).collect()}
    assert gone and {os.path.basename(os.path.dirname(f)) for f in gone} == {"mes=2024-01"}
    # a month that is emptied goes
    empty = make([r for r in new if r[2] != keys[40]])
    assert refresh.refresh_revenue(path, empty, dates, moved, refresh.changed_rows(make(new), empty, ["sk_data"])) == 1
    assert rows(spark.read.parquet(path).select(*want.columns)) == rows(gold.mart_revenue_by_category_day(empty, dates, moved))
