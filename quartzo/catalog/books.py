"""Bookstore operators as batch jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.operators import quality
from quartzo.operators.keys import duplicated_keys
from quartzo.operators.profile import stacked
from quartzo.operators.scan import number
from quartzo.operators.stock import accepted, settle, stock_after
from quartzo.plans import bookstore
from quartzo.session import cut_lineage, scratch
from quartzo.sources.lake import Versions

# Requests of a book are settled one by one: row n sees the stock that row n - 1 left.
TURNS = {
    "pedidos_em_ordem": """SELECT *, row_number() OVER (PARTITION BY livro_id ORDER BY dia, pedido, linha, vendedor, quantidade, centavos,
        desconto, imposto) AS vez FROM pedidos_livro""",
    "pedidos_validos": """SELECT p.livro_id, p.vez, p.quantidade, l.estoque,
        row_number() OVER (PARTITION BY p.livro_id ORDER BY p.vez) AS n
        FROM pedidos_em_ordem p JOIN livros l ON l.id = p.livro_id WHERE p.quantidade > 0""",
    "acertos": """SELECT livro_id, vez, quantidade, n, CAST(estoque AS BIGINT) AS antes,
            CAST(estoque - CASE WHEN quantidade <= estoque THEN quantidade ELSE 0 END AS BIGINT) AS depois FROM pedidos_validos WHERE n = 1
        UNION ALL
        SELECT p.livro_id, p.vez, p.quantidade, p.n, a.depois,
            CAST(a.depois - CASE WHEN p.quantidade <= a.depois THEN p.quantidade ELSE 0 END AS BIGINT)
        FROM acertos a JOIN pedidos_validos p ON p.livro_id = a.livro_id AND p.n = a.n + 1""",
    "decisoes": """SELECT p.livro_id, p.vez, p.quantidade, CASE WHEN l.id IS NULL THEN 'livro_inexistente' WHEN p.quantidade <= 0 THEN 'quantidade_invalida'
        WHEN p.quantidade > a.antes THEN 'estoque_insuficiente' END AS motivo, a.antes AS estoque_antes
        FROM pedidos_em_ordem p LEFT JOIN livros l ON l.id = p.livro_id
        LEFT JOIN acertos a ON a.livro_id = p.livro_id AND a.vez = p.vez""",
}


@query(
    "append_books",
    """SELECT id, titulo, preco FROM livros UNION ALL
       SELECT (SELECT max(id) FROM livros) + row_number() OVER (ORDER BY id), titulo || ' (2a ed.)', preco FROM livros WHERE id % 10 = 0""",
)
def append_books(shop):
    shelf = bookstore.books(shop).select("id", "titulo", "preco")
    new = shelf.filter("id % 10 = 0").select(
        F.col("id").alias("origem"), F.concat("titulo", F.lit(" (2a ed.)")).alias("titulo"), "preco"
    )
    return shelf.unionByName(bookstore.append_books(shelf, new, "origem").drop("origem"))


@query("settle_sales", "SELECT * FROM decisoes", recursive=True, **TURNS)
def settle_sales(shop):
    decided = bookstore.settle_requests(bookstore.requests(shop), bookstore.books(shop))
    return decided.select("livro_id", "vez", "quantidade", "motivo", "estoque_antes")


HOT_TURNS = {
    **TURNS,
    "pedidos_em_ordem": """SELECT l_suppkey % 10 AS livro_id, CAST(l_quantity AS BIGINT) AS quantidade,
        row_number() OVER (PARTITION BY l_suppkey % 10 ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey,
        CAST(l_quantity AS BIGINT), CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS vez FROM lineitem""",
    "pedidos_validos": "SELECT livro_id, vez, quantidade, 5000 AS estoque, vez AS n FROM pedidos_em_ordem",
    "acertos": TURNS["acertos"] + " WHERE a.depois > 0",
}


@query(
    "settle_sales_hot_key",
    """SELECT p.livro_id, p.vez, p.quantidade, CASE WHEN p.quantidade > coalesce(a.antes, 0) THEN 'estoque_insuficiente' END AS motivo,
       coalesce(a.antes, 0) AS estoque_antes FROM pedidos_em_ordem p LEFT JOIN acertos a ON a.livro_id = p.livro_id AND a.vez = p.vez""",
    recursive=True,
    **HOT_TURNS,
)
def settle_sales_hot_key(shop):
    """Ten books share all requests; each is settled in rounds of prefix sums."""
    requests = shop.order_items().select(
        (F.col("seller_id") % 10).alias("livro_id"), F.col("quantity").alias("quantidade"), "shipped_on", "order_id", "item_id", "product_id", "line_cents"
    )
    order = ["shipped_on", "order_id", "item_id", "product_id", "quantidade", "line_cents"]
    turns = number(requests, ["livro_id"], order, "vez").select("livro_id", "vez", "quantidade")
    stock = shop.spark.range(10).select(F.col("id").alias("livro_id"), F.lit(5000).alias("estoque"))
    decided = settle(cut_lineage(turns), stock, "livro_id", "vez", "quantidade", in_task=500)
    return decided.select("livro_id", "vez", "quantidade", "motivo", "estoque_antes")


@query(
    "atomic_publish",
    """SELECT 'venda' AS saida, count(*) AS linhas, CAST(sum(quantidade) AS BIGINT) AS total FROM decisoes WHERE motivo IS NULL
       UNION ALL SELECT 'recusado', count(*), CAST(sum(quantidade) AS BIGINT) FROM decisoes WHERE motivo IS NOT NULL
       UNION ALL SELECT 'estoque', (SELECT count(*) FROM livros), CAST((SELECT sum(estoque) FROM livros) -
       (SELECT sum(quantidade) FROM decisoes WHERE motivo IS NULL) AS BIGINT)""",
    recursive=True,
    **TURNS,
)
def atomic_publish(shop):
    """Sales, refusals and the new stock become visible in one step."""
    shelf = bookstore.books(shop).select(F.col("id").alias("livro_id"), F.col("estoque").cast("bigint").alias("estoque"))
    requests = bookstore.requests(shop)
    decided = cut_lineage(
        bookstore.settle_requests(requests, bookstore.books(shop)).select("livro_id", "vez", "quantidade", "motivo")
    )
    store = Versions(shop.spark, scratch(shop.spark, "versions"))
    store.publish(
        {
            "venda": accepted(decided),
            "recusado": decided.filter("motivo is not null"),
            "estoque": stock_after(shelf, decided, "livro_id", "quantidade"),
        }
    )
    total = lambda name, col: store.read(name).agg(
        F.lit(name).alias("saida"), F.count(F.lit(1)).alias("linhas"), F.sum(col).cast("bigint").alias("total")
    )
    return stacked([total("venda", "quantidade"), total("recusado", "quantidade"), total("estoque", "estoque")])


@query("isbn_unique", "SELECT titulo, count(*) AS vezes FROM livros GROUP BY titulo HAVING count(*) > 1")
def isbn_unique(shop):
    """ISBNs are unique, so their check finds nothing; titles repeat and are found."""
    shelf = bookstore.books(shop)
    return duplicated_keys(shelf, ["isbn"]).withColumnRenamed("isbn", "titulo").unionByName(duplicated_keys(shelf, ["titulo"]))


@query(
    "not_null_checks",
    """SELECT motivos, count(*) AS linhas FROM (SELECT concat_ws(', ', CASE WHEN titulo IS NULL THEN 'titulo_ausente' END,
       CASE WHEN preco IS NULL THEN 'preco_ausente' END, CASE WHEN nullif(estoque % 10, 0) IS NULL THEN 'estoque_ausente' END,
       CASE WHEN autor_id IS NULL THEN 'autor_id_ausente' END) AS motivos FROM livros) GROUP BY motivos""",
)
def not_null_checks(shop):
    """Stocks that are multiples of ten stand for a missing stock, as a null does."""
    shelf = bookstore.books(shop).withColumn("estoque", F.nullif(F.col("estoque") % 10, F.lit(0)))
    checked = quality.check(shelf, bookstore.required(["titulo", "preco", "estoque", "autor_id"]))
    return checked.groupBy("motivos").agg(F.count(F.lit(1)).alias("linhas"))
