"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions.columns import money_sum
from quartzo.functions.domains import CATEGORIES
from quartzo.operators import joins
from quartzo.plans import academic, bookstore, silver


@query(
    "left_join_fk_check",
    """SELECT e.event_id, e._source_file, e.customer_id, c.customer_id IS NULL AS cliente_inexistente,
       e.product_id IS NOT NULL AND p.product_id IS NULL AS produto_inexistente
       FROM raw_events e LEFT JOIN stg_customers c ON c.customer_id = e.customer_id
       LEFT JOIN stg_products p ON p.product_id = e.product_id""",
)
def left_join_fk_check(shop):
    events = shop.events().select("event_id", "_source_file", "customer_id", "product_id")
    customers = shop.customer_ids().select(F.col("customer_id").alias("_c"))
    products = shop.product_ids().select(F.col("product_id").alias("_p"))
    joined = joins.reference_join(events, customers, "customer_id", "_c", "event_id")
    joined = joins.reference_join(joined, products, "product_id", "_p", "event_id")
    return joined.select(
        "event_id",
        "_source_file",
        "customer_id",
        F.col("_c").isNull().alias("cliente_inexistente"),
        (F.col("product_id").isNotNull() & F.col("_p").isNull()).alias("produto_inexistente"),
    )


@query(
    "left_join_enrich",
    """SELECT p.product_id, p.name, k.weight_kg, s.name AS fornecedor, s.state AS uf FROM stg_products p
       LEFT JOIN (SELECT * FROM chk_catalog WHERE motivos = '') k ON k.product_id = p.product_id
       LEFT JOIN stg_suppliers s ON s.supplier_id = p.supplier_id""",
)
def left_join_enrich(shop):
    suppliers = silver.stg_suppliers(shop.suppliers())
    catalog = silver.check_catalog(shop.catalog(), suppliers).filter("motivos = ''").select("product_id", "weight_kg")
    owners = suppliers.select("supplier_id", F.col("name").alias("fornecedor"), F.col("state").alias("uf"))
    products = silver.stg_products(shop.products()).select("product_id", "name", "supplier_id")
    return products.join(catalog, "product_id", "left").join(owners, "supplier_id", "left").drop("supplier_id")


@query(
    "inner_join_star",
    """SELECT i.item_id, i.line_cents, o.status, c.state, p.category FROM raw_order_items i
       JOIN stg_orders o ON o.order_id = i.order_id JOIN stg_customers c ON c.customer_id = o.customer_id
       JOIN stg_products p ON p.product_id = i.product_id""",
)
def inner_join_star(shop):
    orders = silver.stg_orders(shop.orders()).select("order_id", "customer_id", "status")
    buyers = orders.join(shop.customers().select("customer_id", "state"), "customer_id")
    items = shop.order_items().select("item_id", "order_id", "product_id", "line_cents")
    return items.join(buyers, "order_id").join(shop.products().select("product_id", "category"), "product_id").select(
        "item_id", "line_cents", "status", "state", "category"
    )


@query(
    "left_join_payment",
    """SELECT o.order_id, o.total, p.status AS pagamento, p.method FROM stg_orders o LEFT JOIN stg_payments p ON p.order_id = o.order_id""",
)
def left_join_payment(shop):
    payments = silver.stg_payments(shop.payments()).select("order_id", F.col("status").alias("pagamento"), "method")
    return silver.stg_orders(shop.orders()).select("order_id", "total").join(payments, "order_id", "left")


@query(
    "join_validated_1to1",
    """SELECT m.id_aluno, trim(m.curso) AS curso, a.quantidade_acessos FROM matriculas m LEFT JOIN acessos a USING (id_aluno)""",
)
def join_validated_1to1(shop):
    students = academic.enrolments(shop).select("id_aluno", F.trim("curso").alias("curso"))
    return joins.join_validated(students, academic.accesses(shop), ["id_aluno"], "left", "1:1")


@query(
    "author_books",
    """SELECT a.id AS autor_id, a.nome, count(l.id) AS livros, min(l.titulo) AS primeiro_titulo, CAST(sum(l.preco) AS DECIMAL(18,2)) AS total
       FROM autores a LEFT JOIN livros l ON l.autor_id = a.id GROUP BY a.id, a.nome""",
)
def author_books(shop):
    # Books are summed per author before the join: an author may own any share of the books.
    per = bookstore.books(shop).groupBy("autor_id").agg(
        F.count(F.lit(1)).alias("livros"), F.min("titulo").alias("primeiro_titulo"), F.sum("preco").cast("decimal(18,2)").alias("total")
    )
    return bookstore.authors(shop).withColumnRenamed("id", "autor_id").join(per, "autor_id", "left").withColumn(
        "livros", F.coalesce("livros", F.lit(0))
    )


@query("book_author", "SELECT l.id, l.titulo, a.nome AS autor FROM livros l LEFT JOIN autores a ON a.id = l.autor_id")
def book_author(shop):
    names = bookstore.authors(shop).select(F.col("id").alias("autor_id"), F.col("nome").alias("autor"))
    return bookstore.books(shop).select("id", "titulo", "autor_id").join(names, "autor_id", "left").drop("autor_id")


@query(
    "sale_with_items",
    """SELECT o.order_id, o.customer_id, count(i.item_id) AS itens, CAST(coalesce(sum(i.line_cents), 0) AS BIGINT) AS centavos,
       min(i.item_id) AS primeiro, max(i.item_id) AS ultimo,
       string_agg(CAST(i.item_id AS VARCHAR), '|' ORDER BY i.item_id, i.line_cents, i.quantity) AS lista,
       string_agg(coalesce(CAST(i.item_id AS VARCHAR), '') || ':' || coalesce(CAST(i.quantity AS VARCHAR), '') || ':' || coalesce(CAST(i.line_cents AS VARCHAR), ''),
       '|' ORDER BY i.item_id NULLS FIRST, i.line_cents NULLS FIRST, i.quantity NULLS FIRST) FILTER (WHERE i.order_id IS NOT NULL) AS detalhe
       FROM stg_orders o LEFT JOIN raw_order_items i ON i.order_id = o.order_id GROUP BY ALL""",
)
def sale_with_items(shop):
    # A sale's items are one row, whatever their number; detalhe has every field of the list, item by item.
    child = shop.order_items().select("order_id", "item_id", "quantity", "line_cents")
    sales = joins.nested(
        silver.stg_orders(shop.orders()).select("order_id", "customer_id"),
        child,
        ["order_id"],
        ["item_id", "line_cents", "quantity"],
        ["item_id", "quantity", "line_cents"],
        "_itens",
        most=None,
    )
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    cents = F.aggregate("_itens", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["line_cents"], F.lit(0)))
    ids = F.filter(F.transform("_itens", lambda x: x["item_id"]), lambda x: x.isNotNull())
    shown = F.transform("_itens", lambda x: F.concat_ws(":", text(x["item_id"]), text(x["quantity"]), text(x["line_cents"])))
    return sales.withColumn("_ids", ids).select(
        "order_id",
        "customer_id",
        F.coalesce(F.array_size("_ids").cast("bigint"), F.lit(0)).alias("itens"),
        F.coalesce(cents, F.lit(0)).alias("centavos"),
        F.array_min("_ids").alias("primeiro"),
        F.array_max("_ids").alias("ultimo"),
        F.when(F.array_size("_ids") > 0, F.array_join(F.transform("_ids", lambda x: x.cast("string")), "|")).alias("lista"),
        F.array_join(shown, "|").alias("detalhe"),
    )


@query(
    "domain_map_join",
    "SELECT product_id, r.category AS categoria_recebida, d.categoria AS categoria_padronizada, _source_file "
    "FROM raw_catalog r LEFT JOIN domain d ON regexp_full_match(r.category, d.grafias)",
)
def domain_map_join(shop):
    received = shop.catalog().select("product_id", F.col("category").alias("categoria_recebida"), "_source_file")
    official = shop.spark.createDataFrame([(x,) for x in CATEGORIES], "categoria string")
    return joins.domain_table_join(received, "categoria_recebida", F.broadcast(official), "categoria", "categoria_padronizada")


@query(
    "anti_products_without_sales",
    "SELECT product_id, name FROM raw_products WHERE product_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)",
)
def anti_products_without_sales(shop):
    sold = shop.table("lineitem").select(F.col("l_partkey").alias("product_id"))
    return shop.products().select("product_id", "name").join(sold, "product_id", "left_anti")


@query(
    "anti_orders_without_payment",
    "SELECT order_id, status, total FROM stg_orders o WHERE NOT EXISTS (SELECT 1 FROM raw_payments p WHERE p.order_id = o.order_id)",
)
def anti_orders_without_payment(shop):
    orders = silver.stg_orders(shop.orders()).select("order_id", "status", "total")
    return orders.join(shop.payments().select("order_id"), "order_id", "left_anti")


@query(
    "semi_recurring",
    """SELECT customer_id, name, state FROM raw_customers WHERE customer_id IN
       (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 2)""",
)
def semi_recurring(shop):
    often = shop.table("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return shop.customers().select("customer_id", "name", "state").join(often, "customer_id", "left_semi")


@query(
    "join_duplication_check",
    """SELECT (SELECT count(*) FROM orders) AS linhas_antes, count(*) AS linhas_depois,
       count(*) - (SELECT count(*) FROM orders) AS linhas_a_mais
       FROM orders o LEFT JOIN raw_payments p ON p.order_id = o.o_orderkey""",
)
def join_duplication_check(shop):
    orders = shop.table("orders").select(F.col("o_orderkey").alias("order_id"))
    return joins.rows_added_by_join(orders, shop.payments().select("order_id"), ["order_id"])


@query(
    "broadcast_join",
    """SELECT n_name AS uf, count(*) AS clientes, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS saldo
       FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def broadcast_join(shop):
    customers = shop.table("customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_acctbal"))
    states = shop.table("nation").select("n_nationkey", F.col("n_name").alias("uf"))
    joined = joins.size_checked_join(customers, states, ["n_nationkey"])
    return joined.groupBy("uf").agg(F.count(F.lit(1)).alias("clientes"), money_sum("c_acctbal").alias("saldo"))


@query(
    "skew_join",
    """SELECT s.state AS uf, count(*) AS linhas, CAST(sum(l.l_quantity) AS BIGINT) AS quantidade
       FROM lineitem l LEFT JOIN raw_suppliers s ON s.supplier_id = l.l_suppkey GROUP BY 1""",
)
def skew_join(shop):
    lines = shop.table("lineitem").select(F.col("l_suppkey").alias("supplier_id"), "l_quantity")
    joined = joins.salted_join(lines, shop.suppliers().select("supplier_id", "state"), ["supplier_id"])
    return joined.groupBy(F.col("state").alias("uf")).agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("l_quantity").cast("bigint").alias("quantidade")
    )
