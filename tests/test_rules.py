"""Rules, gates and guarded joins: each with a case that passes and one that fails."""

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quartzo.functions import columns as c
from quartzo.operators import changes, compare, joins, keys, lookup, profile, quality
from quartzo.plans import academic, silver, validate


def test_duplicate_events_and_two_reasons(spark, rows):
    cols = "event_id bigint, session_id string, customer_id bigint, product_id bigint, order_id bigint, event_type string, event_at string, device string, source string, _source_file string"
    e = lambda i, cust, prod, kind, at, dev, file: (i, "s", cust, prod, None, kind, at, dev, "email", file)
    good = "2026-09-01T02:09:42+00:00"
    events = spark.createDataFrame(
        [
            e(1, 1, 5, " PAGE_VIEW ", good, "Web", "events/a.jsonl"),
            e(1, 1, 5, "page_view", good, None, "events/b.jsonl"),
            e(2, 1, None, "   ", good, "web", "events/a.jsonl"),
            e(3, 9, None, "x", "data-invalida", "web", "events/a.jsonl"),
            e(4, None, 6, "x", "2026-09-01 02:09:42", "web", "events/a.jsonl"),
        ],
        cols,
    )
    customers = spark.createDataFrame([(1,)], "customer_id bigint")
    products = spark.createDataFrame([(5,)], "product_id bigint")
    checked = silver.check_events(events, customers, products)
    got = rows(checked.select("event_id", "_source_file", "motivos"))
    assert got == [
        (1, "events/a.jsonl", ""),
        (1, "events/b.jsonl", "duplicado, dispositivo_ausente"),
        (2, "events/a.jsonl", "tipo_ausente"),
        (3, "events/a.jsonl", "data_invalida, cliente_inexistente"),
        (4, "events/a.jsonl", "cliente_inexistente, produto_inexistente"),
    ]
    row = checked.filter("event_id = 1 and ocorrencia = 1").first()
    assert (row.event_type, row.device, row.event_at) == ("page_view", "web", datetime.datetime(2026, 9, 1, 2, 9, 42))
    held = silver.quarantine(checked, datetime.datetime(2026, 10, 14))
    assert held.filter("event_id = 3").first().event_at_raw == "data-invalida"
    assert {r.motivo: r.linhas for r in quality.reason_counts(checked).collect()}["cliente_inexistente"] == 2
    known = silver.recheck_events(held, customers.unionByName(spark.createDataFrame([(9,)], "customer_id bigint")), products)
    assert known.filter("event_id = 3").first().motivos == "data_invalida"


def test_gate(spark):
    df = spark.createDataFrame([("d1", "")] * 9 + [("d1", "x")] + [("d2", "")] * 10, "lote string, motivos string")
    quality.gate(df, F.col("lote"), 10)
    worse = df.unionByName(spark.createDataFrame([("d2", "x"), ("d2", "x")], "lote string, motivos string"))
    with pytest.raises(quality.BlockedRun, match="d2: 2/12"):
        quality.gate(worse, F.col("lote"), 10)


def test_report_and_reconcile(spark):
    checked = spark.createDataFrame([(1, "")] * 96 + [(2, "a"), (3, "a, b"), (4, "b"), (5, "b")], "id int, motivos string")
    assert tuple(quality.report(checked, "t").first()) == ("t", 100, 96, 4, Decimal("4.00"))
    good, bad = quality.split(checked)
    assert quality.reconcile(checked, good, bad, "t").first().fecha
    assert not quality.reconcile(checked, good, bad.limit(1), "t").first().fecha


def test_fix_and_alert_rules(spark, rows):
    df = spark.createDataFrame([("BELEZA", 1), ("Pet", 2)], "cat string, n int")
    rules = [
        quality.Rule("grafia", F.col("cat") == "BELEZA", "fix", "cat", F.lit("Beleza")),
        quality.Rule("par", F.col("n") % 2 == 0, "alert"),
    ]
    assert rows(quality.check(df, rules)) == [("Beleza", 1, "", ""), ("Pet", 2, "", "par")]


def test_scorecard(spark):
    df = spark.createDataFrame([("x", "r"), (None, ""), ("x", ""), (None, "r")], "label string, motivos string")
    assert tuple(quality.scorecard(df, F.col("label").isNotNull()).first()) == (1, 1, 1, 1)


def test_range_gate(spark):
    df = spark.createDataFrame([(1, Decimal("9.50")), (2, None)], "id int, nota decimal(4,2)")
    assert quality.range_gate(df, "nota", 0, 10).count() == 2
    bad = spark.createDataFrame([(1, Decimal("11.00"))], "id int, nota decimal(4,2)")
    with pytest.raises(PySparkException, match="out of range"):
        quality.range_gate(bad, "nota", 0, 10).collect()


def test_strict_number(spark):
    ok = spark.createDataFrame([("8.5",), (None,)], "x string")
    assert [r[0] for r in ok.select(c.strict_number("x")).collect()] == [8.5, None]
    bad = spark.createDataFrame([("abc",)], "x string")
    assert bad.select(c.number_or_null("x")).first()[0] is None
    with pytest.raises(PySparkException, match="not a number"):
        bad.select(c.strict_number("x")).collect()


def test_guarded_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, l string")
    right = spark.createDataFrame([(1, 10)], "id int, r int")
    assert rows(joins.join_validated(left, right, ["id"])) == [(1, "a", 10), (2, "b", None)]
    twice = right.unionByName(right)
    with pytest.raises(PySparkException, match="repeated key on the right side"):
        joins.join_validated(left, twice, ["id"]).collect()
    with pytest.raises(PySparkException, match="repeated key on the right side"):
        joins.join_validated(left, twice, ["id"]).agg(F.count(F.lit(1))).collect()
    with pytest.raises(PySparkException, match="repeated key on the left side"):
        joins.join_validated(left.unionByName(left), right, ["id"]).collect()
    assert joins.join_validated(left.unionByName(left), right, ["id"], validate="m:1").count() == 4
    assert joins.join_validated(left, twice, ["id"], validate="1:m").count() == 3
    with pytest.raises(ValueError):
        joins.join_validated(left, right, ["id"], validate="2:1")


def test_academic_example(spark, rows):
    students = spark.createDataFrame([(101, "BSI", "8.5"), (102, "Sistemas de Informacao", "7.0"), (103, " BSI ", "9.0")], "id_aluno int, curso string, nota string")
    visits = spark.createDataFrame([(101, 15), (102, 8)], "id_aluno int, quantidade_acessos bigint")
    name = "SISTEMAS DE INFORMAÇÃO"
    assert rows(academic.transform(students, visits).select("id_aluno", "curso", "nota", "quantidade_acessos")) == [
        (101, name, Decimal("8.50"), 15),
        (102, name, Decimal("7.00"), 8),
        (103, name, Decimal("9.00"), 0),
    ]
    for bad, message in (("11", "out of range"), ("abc", "not a number")):
        with pytest.raises(PySparkException, match=message):
            academic.transform(students.withColumn("nota", F.lit(bad)), visits).collect()


def test_versions(spark):
    df = spark.createDataFrame(
        [(42, "paid", "2026-09-10 10:00:00"), (42, "shipped", "2026-09-12 08:30:00"), (43, "paid", "2026-09-01 00:00:00")],
        "order_id int, status string, updated_at string",
    )
    assert {r.order_id: r.status for r in keys.latest_version(df, ["order_id"], ["updated_at"]).collect()} == {42: "shipped", 43: "paid"}


def test_changes(spark, rows):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "id int, v string, seq int")
    new = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (2, "old", 4), (3, "n", 1)], "id int, v string, seq int")
    assert rows(changes.upsert(base, new, ["id"], "seq")) == [(1, "y", 3), (2, "b", 5), (3, "n", 1)]
    log = spark.createDataFrame([(1, "z", 1, "U"), (1, None, 2, "D"), (4, "i", 3, "I"), (9, None, 4, "D")], "id int, v string, seq int, op string")
    assert rows(changes.apply_cdc(base.drop("seq"), log, ["id"], "seq", "op")) == [(2, "b"), (4, "i")]
    assert rows(changes.delete_keys(base, new, ["id"])) == []


def test_domain_spelling(spark):
    df = spark.createDataFrame([(x,) for x in ("beleza", "BELEZA", " Jardim", "M0da", "eletrônicos", "Nada", None)], "k string")
    from quartzo.functions.domains import CATEGORIES

    got = [r.v for r in joins.domain_join(df, "k", CATEGORIES, "v").orderBy(F.monotonically_increasing_id()).collect()]
    assert got == ["Beleza", "Beleza", "Jardim", "Moda", "Eletrônicos", None, None]


def test_join_that_multiplies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "id int, p string")
    assert tuple(joins.rows_added_by_join(left, right, ["id"]).first()) == (3, 5, 2)


def test_nested_gives_one_row_or_fails(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 6 - i) for i in range(7)], "id int, n int")
    got = joins.nested(parent, child, ["id"], ["n"], ["n"], "filhos", most=7).collect()
    assert {r.id: [x.n for x in r.filhos] if r.filhos else None for r in got} == {1: [0, 1, 2, 3, 4, 5, 6], 2: None} and len(got) == 2
    with pytest.raises(Exception, match="more than 6 children"):
        joins.nested(parent, child, ["id"], ["n"], ["n"], "filhos", most=6).collect()


def test_an_order_may_have_any_number_of_items(spark, monkeypatch):
    from quartzo.catalog.base import REGISTRY

    monkeypatch.setattr(silver, "stg_orders", lambda orders: orders)

    class Shop:
        def orders(self):
            return spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "order_id long, customer_id long")

        def order_items(self):
            hot = spark.range(3000).select(F.lit(1).cast("long").alias("order_id"), (2999 - F.col("id")).alias("item_id"), F.lit(2).alias("quantity"), F.lit(5).cast("long").alias("line_cents"))
            return hot.union(spark.createDataFrame([(2, 5, 1, 4), (2, None, 1, 3)], "order_id long, item_id long, quantity int, line_cents long"))

    sales = {r.order_id: r for r in REGISTRY["sale_with_items"].build(Shop()).collect()}
    assert (sales[1].itens, sales[1].centavos, sales[1].primeiro, sales[1].ultimo) == (3000, 15000, 0, 2999)
    assert tuple(sales[2])[2:] == (1, 7, 5, 5) and tuple(sales[3])[2:] == (0, 0, None, None)
    lines = REGISTRY["explode_nested"].build(Shop())
    assert lines.columns == ["order_id", "customer_id", "item_id", "quantity"]
    assert lines.groupBy("order_id").count().orderBy("order_id").collect() == [(1, 3000), (2, 2), (3, 1)]


def test_missing_stocks_are_found(spark):
    from quartzo.catalog.base import REGISTRY

    class Shop:
        def table(self, name):
            rows = [(1, "a", 1.0, 7), (2, "b", 1.0, 20), (3, "c", 1.0, None), (4, None, 1.0, 10), (5, "e", None, 11), (6, "f", 1.0, 3)]
            return spark.createDataFrame(rows, "p_partkey long, p_name string, p_retailprice double, p_size int")

    got = {r.motivos: r.linhas for r in REGISTRY["not_null_checks"].build(Shop()).collect()}
    assert got == {"": 2, "estoque_ausente": 2, "titulo_ausente, estoque_ausente": 1, "preco_ausente": 1}


def test_a_sale_lists_its_items(spark, monkeypatch):
    from quartzo.catalog.base import REGISTRY

    monkeypatch.setattr(silver, "stg_orders", lambda orders: orders)

    class Shop:
        def orders(self):
            return spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, 9)], "order_id long, customer_id long")

        def order_items(self):
            lines = [(1, i, 2, 5) for i in range(1500, -1, -1)] + [(2, 5, 1, 4), (2, None, 1, 3), (2, 5, 1, 4), (4, None, 1, 1)]
            return spark.createDataFrame(lines, "order_id long, item_id long, quantity int, line_cents long")

    sales = {r.order_id: r for r in REGISTRY["sale_with_items"].build(Shop()).collect()}
    assert [sales[i].lista for i in (1, 2, 3, 4)] == ["|".join(map(str, range(1501))), "5|5", None, None]
    assert (sales[2].itens, sales[2].centavos, sales[2].primeiro, sales[2].ultimo) == (2, 11, 5, 5)


def test_a_sale_holds_its_items_whole(spark, monkeypatch):
    """Number, quantity and value of every item, in order, also without a number; items without an order are nobody's."""
    from quartzo.catalog.base import REGISTRY

    monkeypatch.setattr(silver, "stg_orders", lambda orders: orders)

    class Shop:
        def orders(self):
            return spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, 9), (None, 9)], "order_id long, customer_id long")

        def order_items(self):
            lines = [(1, i, i % 50, 2 * i) for i in range(1500, -1, -1)] + [(2, 5, 3, 40), (2, 5, 2, 40), (2, 5, 9, 4), (2, None, 1, 3)]
            lines += [(4, 6, None, None), (None, 1, 1, 1), (None, 2, 2, 2), (9, 1, 1, 1)]
            return spark.createDataFrame(lines, "order_id long, item_id long, quantity int, line_cents long")

    sales = {r.order_id: r for r in REGISTRY["sale_with_items"].build(Shop()).collect()}
    assert len(sales) == 5 and sales[1].detalhe == "|".join(f"{i}:{i % 50}:{2 * i}" for i in range(1501))
    assert [sales[i].detalhe for i in (2, 3, 4, None)] == [":1:3|5:9:4|5:2:40|5:3:40", None, "6::", None]
    assert [sales[i].lista for i in (2, 3, 4, None)] == ["5|5|5", None, "6", None]
    assert [(sales[i].itens, sales[i].centavos, sales[i].primeiro, sales[i].ultimo) for i in (2, 3, 4)] == [(3, 87, 5, 5), (0, 0, None, None), (1, 0, 6, 6)]


def test_nested_without_a_bound(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1, 1499 - i, str(i)) for i in range(1500)] + [(None, 5, "x")], "id int, n int, s string")
    got = {r.id: r.filhos for r in joins.nested(parent, child, ["id"], ["n"], ["s", "n"], "filhos", most=None).collect()}
    assert [(x.s, x.n) for x in got[1]] == [(str(1499 - i), i) for i in range(1500)] and got[2] is None and got[None] is None


def test_unreadable_stock_is_rejected(spark):
    rows = [(1, "5"), (2, "abc"), (3, "-1"), (4, None)]
    got = silver.check_inventory(spark.createDataFrame(rows, "product_id int, quantity string")).collect()
    assert {r.product_id: r.motivos for r in got} == {1: "", 2: "quantidade_ilegivel", 3: "estoque_negativo", 4: ""}


def test_contents(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, s string")
    assert tuple(compare.contents_equal(a, a).first()) == (True, 0)
    assert compare.contents_equal(a, a.dropDuplicates()).first().linhas_diferentes == 1
    assert not compare.contents_equal(a, a.select("s", "id")).first().mesmas_colunas


def test_search_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("100% Casa",), ("casa velha",), ("outra",)], "titulo string")
    assert lookup.search(df, "titulo", "CASA").count() == 2
    assert lookup.search(df, "titulo", "%").count() == 1
    assert lookup.query_with(df, "SELECT * FROM {source} WHERE titulo = :t", t="outra").count() == 1


def test_profiles(spark):
    df = spark.createDataFrame([(1, 2.0), (1, float("nan")), (None, None), (None, 1.0)], "id int, x double")
    assert {r.coluna: r.ausentes for r in profile.null_pct(df).collect()} == {"id": 2, "x": 2}
    assert df.agg(profile.repeats("id")).first()[0] == 2
    assert [(r.coluna, r.tipo) for r in profile.column_types(df).collect()] == [("id", "int"), ("x", "double")]


def test_failed_checks_are_reported(spark):
    fact = spark.createDataFrame([(1, 10), (1, 99)], "item_id int, sk int")
    dim = spark.createDataFrame([(10,)], "sk int")
    assert not validate.fact_grain(fact).first().ok
    assert not validate.no_orphan_keys([(fact, "sk", dim)]).first().ok
    assert validate.no_orphan_keys([(fact.filter("sk = 10"), "sk", dim)]).first().ok
    assert not validate.unique_key(fact, "item_id", "t").first().ok
    assert not validate.dim_keys_unique({"d": (dim.unionByName(dim), "sk")}).first().ok
    assert not validate.bronze_preserves_landing(fact, dim).first().ok
    with pytest.raises(validate.FailedChecks, match="grao_fato_vendas"):
        validate.require(validate.fact_grain(fact))


def test_items_without_parents_are_reported(spark, rows):
    from quartzo.plans import gold

    items = spark.createDataFrame([(1, 10, 5), (2, 11, 5), (3, 10, 6)], "item_id int, order_id int, product_id int")
    orders, products = spark.createDataFrame([(10,)], "order_id int"), spark.createDataFrame([(5,)], "product_id int")
    assert rows(gold.orphan_items(items, orders, products)) == [(2, "pedido"), (3, "produto")]
