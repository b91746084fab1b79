"""Keys, stock, history and medians must equal brute force, with one key holding a third of the rows."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quartzo.operators import changes, joins, keys, median, stock


def skewed(n=600, seed=1):
    """(k, t, u, v): key 7 has a third of the rows, some rows are exact copies."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = 7 if i % 3 == 0 else r.randrange(40)
        out.append((k, r.randrange(50), i, r.randrange(-5, 20)))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "k int, t int, u int, v int").repartition(5).cache()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join(spark, frame, rows, how):
    left = frame.withColumn("k", F.when(F.col("u") % 11 != 0, F.col("k")))
    right = spark.createDataFrame([(i, f"name {i}") for i in range(0, 40, 2)] + [(7, "hot"), (None, "none")], "k int, name string")
    got = joins.salted_join(left, right, ["k"], how, salts=5)
    expected = left.join(right, "k", how)
    assert got.columns == expected.columns and rows(got) == rows(expected)


def test_reference_join_spreads_missing_keys(spark, rows):
    left = spark.createDataFrame([(i, None if i % 3 else i % 7) for i in range(600)] + [(None, None)], "id bigint, ref bigint")
    right = spark.createDataFrame([(i,) for i in range(5)], "other bigint")
    got = joins.reference_join(left, right, "ref", "other", "id")
    assert rows(got) == rows(left.join(right, F.col("ref") == F.col("other"), "left"))


def test_surrogate_key(spark):
    values = [10**15, *random.Random(3).sample(range(-(10**6), 10**9), 500)]
    df = spark.createDataFrame([(v, str(v)) for v in values], "id bigint, s string").repartition(7)
    got = keys.surrogate_key(df, "id", "sk")
    assert got.columns == ["sk", "id", "s"] and {r.id: r.sk for r in got.collect()} == {v: i + 1 for i, v in enumerate(sorted(values))}
    by_text = keys.surrogate_key(df, "s", "sk").collect()
    assert {r.s: r.sk for r in by_text} == {s: i + 1 for i, s in enumerate(sorted(str(v) for v in values))}


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 50 + [1e12, -4.5], [float(i * i) for i in range(101)], [0.0] * 10 + [1e9] * 10, [2.0**-i for i in range(900)] + [3.0] * 899])
@pytest.mark.parametrize("accuracy", [4, 20, 10_000])
def test_exact_median(spark, values, accuracy):
    import statistics

    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert median.exact_median(df, "v", accuracy=accuracy).first()[0] == pytest.approx(statistics.median(values))


def test_median_of_nothing(spark):
    assert median.exact_median(spark.createDataFrame([(None,)], "v double"), "v").first()[0] is None


def brute_settle(requests, on_hand):
    left, out = dict(on_hand), {}
    for book, seq, qty in sorted(requests, key=lambda r: (r[0], r[1])):
        if book not in left:
            out[(book, seq)] = ("livro_inexistente", None)
        elif qty is None or qty <= 0:
            out[(book, seq)] = ("quantidade_invalida", None)
        else:
            out[(book, seq)] = (None if qty <= left[book] else "estoque_insuficiente", left[book])
            left[book] -= qty if qty <= left[book] else 0
    return out, left


@pytest.mark.parametrize("in_task", [1_000_000, 20, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_settle(spark, in_task, seed):
    r = random.Random(seed)
    on_hand = {b: r.choice([0, 1, 10, 57, 500, 3000]) for b in range(6)}
    requests = []
    for book in range(7):
        for seq in range(1, 200 if book in (2, 4) else r.randrange(2, 30)):
            requests.append((book, seq, r.choice([0, 1, 2, 3, 8, 15, 16, 17, 40, 64, 100, 900])))
    df = spark.createDataFrame(requests, "livro bigint, vez bigint, qtd bigint").repartition(3)
    shelf = spark.createDataFrame(list(on_hand.items()), "livro bigint, estoque int")
    decided = stock.settle(df, shelf, "livro", "vez", "qtd", in_task=in_task)
    got = {(x.livro, x.vez): (x.motivo, x.estoque_antes) for x in decided.collect()}
    expected, left = brute_settle(requests, on_hand)
    assert got == expected
    after = {x.livro: x.estoque for x in stock.stock_after(shelf, decided, "livro", "qtd").collect()}
    assert after == left


def test_order_matters(spark):
    """Stock 10, requests 5, 9, 4, 2: the refused 9 must not use stock."""
    df = spark.createDataFrame([(1, i, q) for i, q in enumerate([5, 9, 4, 2], 1)], "livro bigint, vez bigint, qtd bigint")
    shelf = spark.createDataFrame([(1, 10)], "livro bigint, estoque int")
    for in_task in (1_000_000, 2):
        decided = stock.settle(df, shelf, "livro", "vez", "qtd", in_task=in_task)
        assert sorted(r.vez for r in stock.accepted(decided).collect()) == [1, 3]
        assert stock.stock_after(shelf, decided, "livro", "qtd").first().estoque == 1


def test_history_and_lookup(spark):
    r = random.Random(5)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    seen = {}
    for i in range(400):
        seen[(7 if i % 3 == 0 else r.randrange(30), r.randrange(900))] = r.choice("abc")
    df = spark.createDataFrame([(k, day(d), s) for (k, d), s in seen.items()], "id bigint, dia date, seg string")
    history = changes.scd2(df, "id", ["seg"], "dia")
    got = {(x.id, x.valido_de): (x.seg, x.valido_ate, x.atual) for x in history.collect()}
    expected = {}
    for k in {k for k, _ in seen}:
        line = sorted((d, s) for (kk, d), s in seen.items() if kk == k)
        starts = [p for i, p in enumerate(line) if i == 0 or line[i - 1][1] != p[1]]
        for i, (d, s) in enumerate(starts):
            end = day(starts[i + 1][0]) if i + 1 < len(starts) else datetime.date(9999, 12, 31)
            expected[(k, day(d))] = (s, end, i + 1 == len(starts))
    assert got == expected

    facts = spark.createDataFrame([(i, 7 if i % 3 == 0 else r.randrange(35), day(r.randrange(950))) for i in range(300)], "f int, id bigint, quando date")
    found = changes.asof_dim(facts, history, "id", "quando", ["seg"]).collect()
    assert len(found) == 300
    for x in found:
        valid = [s for (k, start), (s, end, _) in expected.items() if k == x.id and start <= x.quando < end]
        assert x.seg == (valid[0] if valid else None)


def test_moved_customer(spark):
    """Customer 727 lives in SP until 2026-09-20, then in RJ."""
    moves = spark.createDataFrame(
        [(727, datetime.date(2025, 7, 25), "SP"), (727, datetime.date(2026, 1, 1), "SP"), (727, datetime.date(2026, 9, 20), "RJ")],
        "customer_id bigint, dia date, uf string",
    )
    spans = sorted((r.uf, str(r.valido_de), str(r.valido_ate), r.atual) for r in changes.scd2(moves, "customer_id", ["uf"], "dia").collect())
    assert spans == [("RJ", "2026-09-20", "9999-12-31", True), ("SP", "2025-07-25", "2026-09-20", False)]


def test_money_helpers(spark):
    from quartzo.functions import columns as c

    df = spark.createDataFrame([(1999, 19.99, 3, 10)], "cents bigint, price double, qty int, pct int")
    row = df.select(
        c.cents_to_money("cents").alias("a"),
        c.to_cents("price").alias("b"),
        c.line_total("qty", c.cents_to_money("cents"), "pct").alias("c"),
        c.line_total("qty", c.cents_to_money("cents")).alias("d"),
    ).first()
    assert row == (Decimal("19.99"), 1999, Decimal("53.97"), Decimal("59.97"))
