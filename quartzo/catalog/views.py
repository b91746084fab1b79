"""SQL twins of the derived tables, for checking results with another engine."""

from __future__ import annotations

import re

from quartzo.functions.domains import CATEGORIES


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {whens} END"


GHOST = 1_000_000_000
STEP = (
    "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_product' WHEN 'signup' THEN 'add_to_cart' "
    "WHEN 'error' THEN 'checkout' WHEN 'purchase' THEN 'purchase' END"
)

VIEWS: dict[str, str] = {
    "raw_suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS name, n_name AS state
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS name, n_name AS state,
               DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS since
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_products": f"""
        SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS name,
               {_pick("p_partkey", CATEGORIES)} AS category,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS price_cents,
               CASE WHEN p_partkey % 97 = 0 THEN p_partkey + {GHOST} ELSE p_partkey % 10 END AS supplier_id
        FROM part""",
    "catalog_first": f"""
        SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, {_pick("p_partkey // 3", CATEGORIES)} AS official,
               CASE WHEN p_partkey % 11 = 0 THEN upper({_pick("p_partkey // 3", CATEGORIES)})
                    WHEN p_partkey % 11 = 1 THEN lower({_pick("p_partkey // 3", CATEGORIES)})
                    WHEN p_partkey % 11 = 2 THEN ' ' || {_pick("p_partkey // 3", CATEGORIES)}
                    WHEN p_partkey % 11 = 3 THEN replace({_pick("p_partkey // 3", CATEGORIES)}, 'o', '0')
                    WHEN p_partkey % 11 = 4 AND p_partkey % 7 = 0 THEN 'Desconhecida'
                    ELSE {_pick("p_partkey // 3", CATEGORIES)} END AS category,
               CASE WHEN p_partkey % 83 = 0 THEN '' ELSE p_size || '.5' END AS weight_kg,
               CAST(CASE WHEN p_partkey % 89 = 0 THEN p_partkey + {GHOST} ELSE p_partkey % 10 END AS VARCHAR) AS supplier_id
        FROM part""",
    "raw_catalog": """
        SELECT product_id, category, weight_kg, supplier_id, 'csv/catalog.csv' AS _source_file FROM catalog_first
        UNION ALL
        SELECT product_id, category, weight_kg, supplier_id, 'csv/catalog_late.csv' FROM catalog_first WHERE p_partkey % 101 = 0""",
    "raw_inventory": """
        SELECT p_partkey AS product_id, DATE '2024-01-01' + CAST(week * 7 AS INTEGER) AS snapshot_date,
               CAST(CASE WHEN (p_partkey + week) % 173 = 0 THEN -p_size ELSE p_size + week END AS VARCHAR) AS quantity
        FROM part, range(5) AS w(week)""",
    "raw_campaigns": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, 'Campanha ' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS name,
               {_pick("n_nationkey", ["direct", "email", "organic", "search", "social", "affiliate"])} AS channel
        FROM nation""",
    "orders_last": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 7 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'DELIVERED'
                    WHEN o_orderstatus = 'O' THEN 'shipped' ELSE ' paid ' END AS status,
               {_pick("o_orderkey", ["WEB", "app", "Marketplace"])} AS channel,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS total_cents,
               CAST(o_orderdate AS DATE) AS created_at,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 + 1 AS INTEGER) AS updated_at
        FROM orders""",
    "raw_orders": """
        SELECT * FROM orders_last
        UNION ALL
        SELECT order_id, customer_id, 'paid', channel, total_cents, created_at, created_at FROM orders_last WHERE order_id % 8 = 0""",
    "payments_last": f"""
        SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 = 0 THEN 'refunded' ELSE 'APPROVED' END AS status,
               {_pick("o_orderkey", ["pix", "card", "boleto"])} AS method, CAST(o_orderdate AS DATE) + 2 AS updated_at
        FROM orders WHERE o_orderkey % 29 <> 0""",
    "raw_payments": """
        SELECT * FROM payments_last
        UNION ALL
        SELECT order_id, 'pending', method, updated_at - 1 FROM payments_last WHERE order_id % 31 = 0""",
    "raw_order_items": """
        SELECT l_orderkey * 8 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               (CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
                 // (CAST(l_quantity AS BIGINT) * 2) AS unit_price_cents,
               l_suppkey AS seller_id,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS line_cents,
               CAST(CAST(l_discount AS DECIMAL(12,2)) * 100 AS BIGINT) AS discount_pct,
               CAST(l_shipdate AS DATE) AS shipped_on
        FROM lineitem""",
    "raw_shipments": f"""
        SELECT o_orderkey AS shipment_id,
               CASE WHEN o_orderkey % 61 = 0 THEN o_orderkey + {GHOST} ELSE o_orderkey END AS order_id,
               {_pick("o_custkey", ["carrier-a", "carrier-b", "carrier-c", "carrier-d"])} AS carrier,
               CASE WHEN o_orderkey % 67 = 0 THEN 'UNKNOWN_VALUE' WHEN o_orderkey % 5 = 0 THEN 'IN_TRANSIT'
                    WHEN o_orderkey % 5 = 1 THEN 'Delivered ' ELSE 'DELIVERED' END AS status,
               CAST(o_orderdate AS DATE) + 7 AS promised_at,
               CASE WHEN o_orderkey % 67 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 71 <> 0
                    THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) AS VARCHAR) END AS delivered_at
        FROM orders""",
    "events_k": f"""
        SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
               date_trunc('second', ts) AS moment, {STEP} AS step
        FROM events""",
    "events_first": f"""
        SELECT event_id, user_id || '-' || day AS session_id,
               CASE WHEN event_id % 59 = 0 THEN user_id + {GHOST} ELSE user_id END AS customer_id,
               CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 71 = 0 THEN k + {GHOST} ELSE k END AS product_id,
               CASE WHEN step = 'purchase' THEN event_id END AS order_id,
               CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 4 = 1 THEN upper(step)
                    WHEN event_id % 4 = 2 THEN '  ' || step || ' ' ELSE step END AS event_type,
               CASE WHEN event_id % 53 = 0 THEN 'data-invalida' ELSE strftime(moment, '%Y-%m-%d %H:%M:%S') END AS event_at,
               CASE WHEN event_id % 61 = 0 THEN NULL ELSE {_pick("event_id", ["WEB", "mobile", " Tablet"])} END AS device,
               {_pick("k", ["direct", "email", "organic", "search", "social"])} AS source,
               'events/events_' || day || '.jsonl' AS _source_file,
               CASE WHEN event_id % 59 = 0 THEN 'cliente' WHEN event_id % 53 = 0 THEN 'data'
                    WHEN event_id % 61 = 0 THEN 'dispositivo' WHEN event_id % 5 <> 0 AND event_id % 71 = 0 THEN 'produto'
                    WHEN event_id % 67 = 0 THEN 'tipo' END AS injected_issue
        FROM events_k""",
    "raw_events": """
        SELECT * FROM events_first
        UNION ALL
        SELECT * REPLACE ('events/events_late.jsonl' AS _source_file, 'duplicado' AS injected_issue)
        FROM events_first WHERE event_id % 97 = 0""",
    # silver -----------------------------------------------------------------
    "stg_customers": "SELECT customer_id, trim(name) AS name, trim(state) AS state, since FROM raw_customers",
    "stg_suppliers": "SELECT supplier_id, trim(name) AS name, trim(state) AS state FROM raw_suppliers",
    "stg_products": """
        SELECT product_id, sku, trim(name) AS name, trim(category) AS category,
               CAST(price_cents / 100.0 AS DECIMAL(12,2)) AS price, supplier_id FROM raw_products""",
    "stg_orders": """
        SELECT order_id, m.customer_id, m.status, m.channel, m.total, m.created_at, m.updated_at
        FROM (SELECT order_id, min({'age': -epoch(updated_at), 'customer_id': customer_id, 's': status, 'c': channel, 'cents': total_cents, 'created_at': created_at,
                     'status': lower(trim(status)), 'channel': lower(trim(channel)), 'total': CAST(CAST(total_cents AS DECIMAL(18,2)) / 100 AS DECIMAL(12,2)),
                     'updated_at': updated_at}) AS m
              FROM raw_orders GROUP BY order_id)""",
    "stg_payments": """
        SELECT order_id, m.status, m.method, m.updated_at
        FROM (SELECT order_id, min({'age': -epoch(updated_at), 's': status, 'm': method, 'status': lower(trim(status)), 'method': lower(trim(method)), 'updated_at': updated_at}) AS m
              FROM raw_payments GROUP BY order_id)""",
    "stg_order_items": """
        SELECT DISTINCT ON (item_id) item_id, order_id, product_id, quantity, CAST(unit_price_cents * 0.01 AS DECIMAL(12,2)) AS unit_price
        FROM raw_order_items ORDER BY item_id, shipped_on DESC, order_id, product_id, quantity, unit_price_cents, seller_id,
             line_cents, discount_pct""",
    "event_base": """
        SELECT * REPLACE (nullif(trim(lower(event_type)), '') AS event_type, nullif(trim(lower(device)), '') AS device,
                          nullif(trim(lower(source)), '') AS source, try_cast(event_at AS TIMESTAMP) AS event_at),
               event_at AS event_at_raw, row_number() OVER copies AS ocorrencia
        FROM raw_events
        WINDOW copies AS (PARTITION BY event_id ORDER BY _source_file NULLS FIRST, raw_events.event_at NULLS FIRST, session_id NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST, order_id NULLS FIRST, raw_events.event_type NULLS FIRST, raw_events.device NULLS FIRST, raw_events.source NULLS FIRST, injected_issue NULLS FIRST)""",
    "violations": """
        SELECT event_id, ocorrencia, 1 AS posto, 'duplicado' AS nome FROM event_base WHERE ocorrencia > 1
        UNION ALL SELECT event_id, ocorrencia, 2, 'tipo_ausente' FROM event_base WHERE event_type IS NULL
        UNION ALL SELECT event_id, ocorrencia, 3, 'data_invalida' FROM event_base WHERE event_at IS NULL
        UNION ALL SELECT event_id, ocorrencia, 4, 'dispositivo_ausente' FROM event_base WHERE device IS NULL
        UNION ALL SELECT event_id, ocorrencia, 5, 'cliente_inexistente' FROM event_base ANTI JOIN raw_customers USING (customer_id)
        UNION ALL SELECT event_id, ocorrencia, 6, 'produto_inexistente' FROM event_base ANTI JOIN raw_products USING (product_id) WHERE product_id IS NOT NULL""",
    "chk_events": """
        SELECT b.*, coalesce(v.nomes, '') AS motivos
        FROM event_base b LEFT JOIN (SELECT event_id, ocorrencia, string_agg(nome, ', ' ORDER BY posto) AS nomes FROM violations GROUP BY event_id, ocorrencia) v
             USING (event_id, ocorrencia)""",
    "silver_events": """
        SELECT event_id, session_id, customer_id, product_id, order_id, event_type, event_at, device, source, CAST(event_at AS DATE) AS event_date
        FROM event_base ANTI JOIN violations USING (event_id, ocorrencia)""",
    "domain": """
        SELECT c AS categoria, '(?i) *' || replace(lower(c), 'o', '[o0]') || ' *' AS grafias FROM (SELECT unnest(["""
    + ", ".join(f"'{c}'" for c in CATEGORIES)
    + "]) AS c)",
    "chk_catalog": """
        SELECT k.*, concat_ws(', ',
               CASE WHEN k.weight_kg IS NULL THEN 'peso_ausente' END,
               CASE WHEN s.supplier_id IS NULL THEN 'fornecedor_inexistente' END,
               CASE WHEN k.ocorrencia > 1 THEN 'duplicado' END,
               CASE WHEN k.category IS NULL THEN 'categoria_invalida' END) AS motivos
        FROM (SELECT try_cast(r.product_id AS BIGINT) AS product_id, r.category AS category_raw, d.categoria AS category,
                     try_cast(nullif(trim(r.weight_kg), '') AS DECIMAL(8,2)) AS weight_kg,
                     try_cast(r.supplier_id AS BIGINT) AS supplier_id, _source_file,
                     row_number() OVER (PARTITION BY r.product_id ORDER BY _source_file, r.category, r.weight_kg, r.supplier_id) AS ocorrencia
              FROM raw_catalog r LEFT JOIN domain d ON regexp_full_match(r.category, d.grafias)) k
        LEFT JOIN stg_suppliers s ON s.supplier_id = k.supplier_id""",
    "chk_inventory": """
        SELECT product_id, snapshot_date, try_cast(quantity AS BIGINT) AS quantity,
               concat_ws(', ', CASE WHEN try_cast(quantity AS BIGINT) < 0 THEN 'estoque_negativo' END,
                             CASE WHEN try_cast(quantity AS BIGINT) IS NULL AND trim(quantity) <> '' THEN 'quantidade_ilegivel' END) AS motivos
        FROM raw_inventory""",
    "chk_shipments": """
        SELECT s.*, concat_ws(', ',
               CASE WHEN s.status = 'delivered' AND s.delivered_at IS NULL THEN 'entrega_sem_data' END,
               CASE WHEN o.order_id IS NULL THEN 'pedido_inexistente' END,
               CASE WHEN s.status IS NULL OR s.status NOT IN ('pending', 'in_transit', 'delivered', 'returned')
                    THEN 'status_invalido' END) AS motivos
        FROM (SELECT shipment_id, order_id, nullif(lower(trim(carrier)), '') AS carrier, nullif(lower(trim(status)), '') AS status,
                     promised_at, try_cast(delivered_at AS DATE) AS delivered_at FROM raw_shipments) s
        LEFT JOIN stg_orders o ON o.order_id = s.order_id""",
    # gold -------------------------------------------------------------------
    "dim_cliente": """
        SELECT row_number() OVER (ORDER BY customer_id) AS sk_cliente, customer_id, name AS nome, state AS uf, since AS cliente_desde
        FROM stg_customers""",
    "dim_produto": """
        SELECT sk AS sk_produto, product_id, p.sku, p.name AS nome, p.category AS categoria, p.price AS preco_atual, peso_kg, fornecedor, uf_fornecedor
        FROM (SELECT unnest(ids) AS product_id, CAST(generate_subscripts(ids, 1) AS BIGINT) AS sk FROM (SELECT list(product_id ORDER BY product_id) AS ids FROM stg_products))
        JOIN stg_products p USING (product_id)
        LEFT JOIN (SELECT product_id, max(weight_kg) AS peso_kg FROM chk_catalog GROUP BY product_id, motivos HAVING motivos = '') USING (product_id)
        LEFT JOIN (SELECT supplier_id, name AS fornecedor, state AS uf_fornecedor FROM stg_suppliers) USING (supplier_id)""",
    "fato_vendas": """
        SELECT item_id, order_id, sk_data, sk_cliente, sk_produto, canal, status_pedido, status_pagamento, metodo_pagamento, quantity AS quantidade,
               unit_price AS preco_unitario, CAST(quantity * unit_price AS DECIMAL(18,2)) AS valor_bruto
        FROM stg_order_items
        JOIN (SELECT order_id, max(dia) AS sk_data, max(cliente) AS customer_id, max(canal) AS canal, max(pedido) AS status_pedido, max(pago) AS status_pagamento, max(meio) AS metodo_pagamento
              FROM (SELECT order_id, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS dia, customer_id AS cliente, channel AS canal, status AS pedido, NULL AS pago, NULL AS meio FROM stg_orders
                    UNION ALL SELECT order_id, NULL, NULL, NULL, NULL, status, method FROM stg_payments)
              GROUP BY order_id) USING (order_id)
        JOIN (SELECT customer_id, sk_cliente FROM dim_cliente) USING (customer_id) JOIN (SELECT product_id, sk_produto FROM dim_produto) USING (product_id)""",
    "dim_data": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_data, d AS data, CAST(year(d) AS INTEGER) AS ano,
               CAST(month(d) AS INTEGER) AS mes, CAST(isodow(d) AS INTEGER) AS dia_semana, isodow(d) >= 6 AS fim_de_semana
        FROM (SELECT CAST(unnest(generate_series(min(dia), max(dia), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT created_at AS dia FROM stg_orders UNION ALL SELECT event_date FROM silver_events
                    UNION ALL SELECT promised_at FROM chk_shipments WHERE motivos = ''))""",
    "dim_campanha": """
        SELECT row_number() OVER (ORDER BY campaign_id) AS sk_campanha, campaign_id, name AS nome, channel AS canal
        FROM raw_campaigns""",
    "fato_eventos": """
        SELECT e.event_id, e.session_id, CAST(strftime(e.event_at, '%Y%m%d') AS INTEGER) AS sk_data, c.sk_cliente, p.sk_produto,
               e.event_type AS tipo, e.device AS dispositivo, e.source AS origem, e.order_id
        FROM silver_events e JOIN dim_cliente c ON c.customer_id = e.customer_id
        LEFT JOIN dim_produto p ON p.product_id = e.product_id""",
    "fato_entregas": """
        SELECT shipment_id, order_id, CAST(strftime(promised_at, '%Y%m%d') AS INTEGER) AS sk_data, carrier AS transportadora,
               status, CAST(date_diff('day', promised_at, delivered_at) AS INTEGER) AS dias_atraso,
               delivered_at <= promised_at AS no_prazo
        FROM chk_shipments WHERE motivos = ''""",
    "vendas_validas": """
        SELECT * FROM fato_vendas WHERE order_id IN (SELECT order_id FROM stg_payments WHERE status = 'approved' EXCEPT SELECT order_id FROM stg_orders WHERE status = 'cancelled')""",
    "mart_receita": """
        SELECT created_at AS data, category AS categoria, count(DISTINCT order_id) AS pedidos, CAST(sum(itens) AS BIGINT) AS itens, CAST(sum(valor) AS DECIMAL(18,2)) AS receita
        FROM (SELECT order_id, product_id, sum(quantity) AS itens, sum(quantity * unit_price) AS valor FROM stg_order_items GROUP BY order_id, product_id)
        SEMI JOIN (SELECT order_id FROM stg_payments WHERE status = 'approved' EXCEPT SELECT order_id FROM stg_orders WHERE status = 'cancelled') USING (order_id)
        JOIN (SELECT order_id, customer_id, created_at FROM stg_orders) USING (order_id) SEMI JOIN stg_customers USING (customer_id)
        JOIN (SELECT product_id, category FROM stg_products) USING (product_id)
        GROUP BY created_at, category""",
    # notebooks --------------------------------------------------------------
    "mob_first": """
        SELECT event_id AS evento_id, ts AS data_hora,
               CASE user_id % 4 WHEN 0 THEN 'Manaus' WHEN 1 THEN 'Natal' WHEN 2 THEN 'Palmas' ELSE 'Maceió' END AS cidade,
               CASE WHEN event_id % 41 = 0 THEN 'Onibus' WHEN event_type = 'view' THEN 'ônibus' WHEN event_type = 'click' THEN 'metrô'
                    WHEN event_type = 'signup' THEN 'bicicleta' ELSE 'aplicativo' END AS modal,
               CASE WHEN event_id % 37 <> 0 THEN CAST(value AS DECIMAL(12,2)) END AS distancia_km,
               CAST(CASE WHEN event_id % 43 = 0 THEN -1 WHEN event_id % 47 = 0 THEN 999 WHEN event_id % 49 = 0 THEN 240
                    ELSE CAST((event_id * 7) % 2500 AS DECIMAL(8,1)) / 10 END AS DECIMAL(8,1)) AS duracao_min,
               CASE event_id % 3 WHEN 0 THEN 'chegou' WHEN 1 THEN 'cancelada' ELSE 'parcial' END AS status,
               CASE event_id % 4 WHEN 0 THEN 'validador' WHEN 1 THEN 'sensor' WHEN 2 THEN 'aplicativo' ELSE 'catraca' END AS fonte
        FROM events""",
    "mobility": "SELECT * FROM mob_first UNION ALL SELECT * FROM mob_first WHERE evento_id % 53 = 0",
    "mob_kept": """
        SELECT DISTINCT ON (evento_id) * REPLACE (CASE modal WHEN 'Onibus' THEN 'ônibus' ELSE modal END AS modal)
        FROM mobility ORDER BY evento_id, data_hora NULLS FIRST, cidade NULLS FIRST, mobility.modal NULLS FIRST, distancia_km NULLS FIRST, duracao_min NULLS FIRST, status NULLS FIRST, fonte NULLS FIRST""",
    "mob_valid": "SELECT * FROM mob_kept WHERE duracao_min > 0 AND duracao_min < 240",
    "mob_clean": """
        SELECT * REPLACE (CAST(round(coalesce(CAST(distancia_km AS DOUBLE), (SELECT median(CAST(distancia_km AS DOUBLE)) FROM mob_valid)), 3)
                 AS DECIMAL(13,3)) AS distancia_km) FROM mob_valid""",
    "sales": """
        SELECT i.item_id, i.shipped_on AS data_hora, s.state AS estado, p.category AS categoria, i.quantity AS quantidade,
               CAST(i.unit_price_cents / 100.0 AS DECIMAL(12,2)) AS preco_unitario, i.discount_pct AS desconto_pct
        FROM raw_order_items i JOIN raw_suppliers s ON s.supplier_id = i.seller_id JOIN raw_products p ON p.product_id = i.product_id""",
    "sales_total": """
        SELECT *, CAST((quantidade * CAST(preco_unitario * 100 AS BIGINT) * (100 - desconto_pct) + 50) // 100 / 100.0
                 AS DECIMAL(18,2)) AS valor_total FROM sales""",
    "matriculas": """
        SELECT c_custkey AS id_aluno, CASE c_custkey % 3 WHEN 0 THEN 'BSI' WHEN 1 THEN 'Sistemas de Informacao' ELSE ' BSI ' END AS curso,
               CASE WHEN c_custkey % 13 = 0 THEN 'abc' ELSE CAST(CAST((c_custkey % 101) / 10.0 AS DECIMAL(4,1)) AS VARCHAR) END AS nota
        FROM customer""",
    "acessos": "SELECT user_id AS id_aluno, count(*) AS quantidade_acessos FROM events GROUP BY user_id",
    "livros": """
        SELECT p_partkey AS id, p_name AS titulo, CAST(9780000000000 + p_partkey AS VARCHAR) AS isbn,
               CAST(p_retailprice AS DECIMAL(12,2)) AS preco, p_size AS estoque, p_partkey % 10 AS autor_id FROM part""",
    "autores": "SELECT s_suppkey AS id, s_name AS nome FROM supplier",
    "pedidos_livro": f"""
        SELECT CASE WHEN l_orderkey % 59 = 0 THEN l_partkey + {GHOST} ELSE l_partkey END AS livro_id,
               CASE WHEN l_orderkey % 61 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS quantidade,
               CAST(l_shipdate AS DATE) AS dia, l_orderkey AS pedido, CAST(l_linenumber AS BIGINT) AS linha, l_suppkey AS vendedor,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS centavos,
               CAST(CAST(l_discount AS DECIMAL(12,2)) * 100 AS BIGINT) AS desconto,
               CAST(CAST(l_tax AS DECIMAL(12,2)) * 100 AS BIGINT) AS imposto
        FROM lineitem""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def _needed(sql: str, extra: dict[str, str], seen: list[str]) -> None:
    pattern = re.compile(r"\b(" + "|".join(sorted([*VIEWS, *extra], key=len, reverse=True)) + r")\b")
    for name in pattern.findall(sql):
        if name not in seen:
            body = extra.get(name) or VIEWS[name]
            if body != sql:
                _needed(body, extra, seen)
            if name not in seen:
                seen.append(name)


def with_views(sql: str, recursive: bool = False, **extra: str) -> str:
    """Put the views a statement names, and the ones those name, in front of it."""
    seen: list[str] = []
    _needed(sql, extra, seen)
    if not seen:
        return sql
    ctes = ",\n".join(f"{name} AS ({(extra.get(name) or VIEWS[name]).strip()})" for name in seen)
    body = sql.strip()
    body = f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{body}"
