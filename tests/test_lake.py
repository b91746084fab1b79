"""Formats, layers, whole runs and streams."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from quartzo import cli
from quartzo.operators import changes
from quartzo.operators.quality import BlockedRun
from quartzo.plans import lineage, validate, warehouse
from quartzo.plans.medallion import SOURCES, Medallion
from quartzo.plans.storefront import Storefront
from quartzo.sources import files, formats, lake, relational
from quartzo.sources.control import Control, changed_after, changed_since
from quartzo.streaming import jobs

DATA = "/root/testdata/sf0.001"
RUN = datetime.datetime(2024, 2, 1)
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def text_dates(df):
    return df.select([F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes])


def land(spark, base, **replaced):
    """Put the shop's raw tables into a landing area in their formats."""
    shop = Storefront(spark, DATA)
    frames = {n: getattr(shop, n)() for n in SOURCES}
    frames["order_items"] = frames["order_items"].withColumnRenamed("shipped_on", "updated_at")
    frames["events"] = frames["events"].drop("injected_issue")
    frames.update(replaced)
    for name, df in frames.items():
        path = f"{base}/landing/{name}"
        df = text_dates(df)
        if name == "events":
            day = F.regexp_extract("_source_file", "events_(.+)[.]jsonl", 1)
            df.withColumn("arquivo", day).drop("_source_file").coalesce(1).write.partitionBy("arquivo").json(path)
            continue
        df = df.drop("_source_file")
        fmt = SOURCES[name].fmt
        if fmt == "csv":
            df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        elif fmt == "json":
            df.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).coalesce(1).write.text(path)
        else:
            df.write.json(path)


def listing(spark, path):
    return {r.path for r in formats.file_sizes(spark, path).collect()}


@needs_data
def test_whole_run_twice(spark, tmp_path):
    base = str(tmp_path / "lake")
    land(spark, base)
    flow = Medallion(spark, base, RUN, database="gold_test", max_quarantine_pct=100)
    counted = flow.bronze()
    assert counted["rows"] == sum(flow.landing(n).count() for n in SOURCES)
    first = [tuple(r) for r in flow.run()]
    assert len(first) == 7 and all(ok for _, ok, _ in first)
    figures = lambda: (
        {n: spark.table(f"gold_test.{n}").count() for n in ("dim_cliente", "dim_produto", "fato_vendas", "fato_eventos")},
        flow.tables()["mart_receita_categoria_dia"].agg(F.sum("receita")).first()[0],
        [tuple(r) for r in flow.quality_report().collect()],
    )
    before, folders = figures(), {os.path.dirname(p) for p in listing(spark, flow.lake.path("bronze"))}
    again = [tuple(r) for r in flow.run()]
    assert again == first and figures() == before
    assert {os.path.dirname(p) for p in listing(spark, flow.lake.path("bronze"))} == folders
    for _, read, good, bad, _ in before[2]:
        assert read == good + bad
    assert "event_date=2024-01-14" in str(listing(spark, flow.lake.path("silver", "events")))

    item = spark.table("gold_test.fato_vendas").agg(F.min("item_id")).first()[0]
    t = flow.tables()
    way = lineage.trace(
        item, lake.read_bronze(flow.lake, "order_items"), flow.lake.read("silver", "order_items"), t["fato_vendas"], t["dim_data"], t["dim_produto"]
    ).collect()
    assert len(way) == 1 and way[0].arquivo_landing.startswith("order_items/") and way[0].linhas_silver == 1
    shown = {(r.objeto, r.tipo) for r in warehouse.objects(spark, "gold_test").collect()}
    assert ("fato_vendas", "TABLE") in shown and ("mart_funil_origem", "VIEW") in shown
    assert warehouse.query(spark, "gold_test", "funil-origem").count() == 5
    for command in (
        ["check"],
        ["inspect", "--layer", "quarantine", "--dataset", "events", "--limit", "2"],
        ["quality-report"],
        ["query", "--name", "entregas-transportadora"],
        ["lineage", "--item-id", str(item)],
        ["publish", "--target", base],
    ):
        assert cli.main(["--base", base, *command]) == 0
    warehouse.drop(spark, "gold_test")


@needs_data
def test_bad_day_blocks_the_run(spark, tmp_path):
    base = str(tmp_path / "lake")
    # the late file holds copies only and would block by itself
    events = Storefront(spark, DATA).events().drop("injected_issue").filter("_source_file not like '%late%'")
    bad_day = F.col("_source_file").contains("2024-01-05")
    land(spark, base, events=events.withColumn("device", F.when(bad_day, F.lit(None)).otherwise(F.col("device"))))
    flow = Medallion(spark, base, RUN, max_quarantine_pct=60)
    flow.bronze()
    with pytest.raises(BlockedRun, match="2024-01-05"):
        flow.silver()
    assert not os.path.exists(f"{base}/silver/events")


def test_partition_overwrite_leaves_other_days(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, dia string")
    formats.write_partitioned(df, path, ["dia"])
    kept = [p for p in listing(spark, path) if "dia=b" in p]
    formats.write_partitioned(df.filter("dia = 'a'").withColumn("id", F.lit(9)), path, ["dia"])
    assert [p for p in listing(spark, path) if "dia=b" in p] == kept
    assert rows(spark.read.parquet(path).select("id", "dia")) == [(2, "b"), (9, "a")]


def test_formats(spark, tmp_path, rows):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("s"), F.lit("texto repetido").alias("t"))
    paths = {f: str(tmp_path / f) for f in ("csv", "jsonl", "parquet")}
    for fmt, path in paths.items():
        formats.write_as(df, fmt, path)
    sizes = {r.formato: r.bytes for r in formats.size_report(spark, paths).collect()}
    assert sizes["parquet"] < sizes["csv"] < sizes["jsonl"]
    assert all(t == "string" for _, t in formats.read_csv_text(spark, paths["csv"]).dtypes)
    with pytest.raises(ValueError):
        formats.write_parquet(df, str(tmp_path / "x"), "lzma")
    with pytest.raises(ValueError):
        formats.write_as(df, "xml", str(tmp_path / "x"))
    small = str(tmp_path / "many")
    df.repartition(16).write.parquet(small)
    assert formats.compact(spark, small, str(tmp_path / "few")) == 1
    assert formats.file_sizes(spark, str(tmp_path / "few")).count() == 1
    assert rows(spark.read.parquet(str(tmp_path / "few"))) == rows(df)


def test_publish_by_content(spark, tmp_path):
    src = tmp_path / "src"
    (src / "a").mkdir(parents=True)
    (src / "a" / "one.bin").write_bytes(b"1" * 100)
    (src / "a" / "two.bin").write_bytes(b"2" * 5000)
    by_block, whole = files.manifest(spark, str(src), whole_file=1000), files.manifest(spark, str(src))
    assert sorted(map(tuple, by_block.collect())) == sorted(map(tuple, whole.collect()))
    target = str(tmp_path / "target")
    formats.write_parquet(whole.limit(0), target)
    assert tuple(files.publish_report(whole, spark.read.parquet(target)).first()) == (2, 0, 5100)
    formats.write_parquet(whole, target)
    assert tuple(files.publish_report(files.manifest(spark, str(src)), spark.read.parquet(target)).first()) == (0, 2, 0)
    (src / "a" / "one.bin").write_bytes(b"x" * 100)
    assert [r.key for r in files.changed_files(files.manifest(spark, str(src)), spark.read.parquet(target)).collect()] == ["a/one.bin"]


@pytest.mark.parametrize("low,high,pieces", [(0, 0, 5), (1, 10, 3), (-7, 1000, 8), (3, 4, 9)])
def test_key_ranges_cover_all_rows_once(spark, low, high, pieces):
    df = spark.range(low - 2, high + 3).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k bigint"))
    assert sum(df.filter(p).count() for p in relational.range_predicates("k", low, high, pieces)) == df.count()


def test_watermark_moves_only_when_told(spark, tmp_path):
    control = Control(spark, str(tmp_path / "control"))
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03")], "id int, d string")
    assert control.watermark("t", "2000-01-01") == "2000-01-01"
    control.advance("t", "2024-01-02")
    assert [r.id for r in changed_since(df, "d", control.watermark("t", "x"), "string").collect()] == [2]
    assert control.watermark("other", "2000-01-01") == "2000-01-01"


def test_equal_times_are_not_skipped(spark, tmp_path):
    control = Control(spark, str(tmp_path / "control"))
    df = spark.createDataFrame([(9, "2024-01-01"), (10, "2024-01-01"), (11, "2024-01-01"), (2, "2024-01-02")], "id int, d string")
    assert control.place("t", "2023-01-01") == ("2023-01-01", None)
    control.advance("t", "2024-01-01", "9")
    control.advance("t", "2024-01-01", "10")  # as numbers 10 is above 9
    place = control.place("t", "x", "string", "int")
    assert place == ("2024-01-01", "10") and sorted(r.id for r in changed_after(df, "d", "id", place, "string").collect()) == [2, 11]
    assert sorted(r.id for r in changed_after(df, "d", "id", ("2023-01-01", None), "string").collect()) == [2, 9, 10, 11]


def test_upsert_in_folders_leaves_the_others(spark, tmp_path, rows):
    path, place = str(tmp_path / "t"), (F.col("id") / 10).cast("int")
    df = spark.createDataFrame([(i, 1, "a") for i in range(40)], "id int, seq int, v string")
    formats.write_partitioned(df.withColumn("f", place), path, ["f"])
    before = listing(spark, path)
    late = spark.createDataFrame([(3, 2, "b"), (4, 0, "old"), (57, 1, "new"), (3, 1, "c")], df.schema)
    assert changes.upsert_folders(spark, path, late, ["id"], "seq", "f", place) == [0, 5]
    assert {p for p in before if "f=0/" not in p} <= listing(spark, path) and not {p for p in before if "f=0/" in p} & listing(spark, path)
    assert rows(spark.read.parquet(path).drop("f")) == rows(changes.upsert(df, late, ["id"], "seq"))
    assert changes.upsert_folders(spark, path, late.limit(0), ["id"], "seq", "f", place) == []


def test_failed_batch_stays_invisible(spark, tmp_path):
    store = lake.Versions(spark, str(tmp_path / "v"))
    with pytest.raises(LookupError):
        store.read("a")
    one = spark.createDataFrame([(1,)], "x int")
    assert store.publish({"a": one, "b": one}) == 1
    broken = one.select(F.raise_error(F.lit("stop")).cast("int").alias("x"))
    with pytest.raises(Exception, match="stop"):
        store.publish({"a": one.unionByName(one), "b": broken})
    assert store.current() == 1 and store.read("a").count() == 1
    assert store.publish({"a": one.unionByName(one), "b": one}) == 2 and store.read("a").count() == 2


@needs_data
def test_stream_in_many_batches_equals_batch(spark, tmp_path, rows):
    from quartzo.plans import silver

    shop = Storefront(spark, DATA)
    folder = F.regexp_extract("_source_file", "events_(.+)[.]jsonl", 1)
    landing = str(tmp_path / "landing")
    first = shop.events().filter("_source_file <> 'events/events_late.jsonl'")
    late = shop.events().filter("_source_file = 'events/events_late.jsonl'")
    schema = SOURCES["events"].schema
    put = lambda df: df.withColumn("arquivo", folder).drop("_source_file", "injected_issue").repartition("arquivo").write.mode(
        "append"
    ).partitionBy("arquivo").json(f"{landing}/events")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def go():
        stream = jobs.landing_stream(spark, f"{landing}/events", schema, files_per_batch=12)
        jobs.quality_split(stream, shop.customer_ids(), shop.product_ids(), landing, out, check, RUN)

    put(first)
    go()
    put(late)
    go()
    go()
    want = silver.check_events(shop.events(), shop.customer_ids(), shop.product_ids())
    assert spark.read.parquet(f"{out}/checked").select("_batch").distinct().count() >= 3
    got = spark.read.parquet(f"{out}/checked")
    assert rows(got.select("event_id", "ocorrencia", "motivos")) == rows(want.select("event_id", "ocorrencia", "motivos"))
    totals = {r.saida: r.linhas for r in jobs.all_batches(spark, out, ["silver", "quarantine"]).collect()}
    assert totals["silver"] + totals["quarantine"] == want.count()


def test_stream_sales_carry_the_stock(spark, tmp_path):
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    shelf = spark.createDataFrame([(1, 10), (2, 5)], "livro bigint, estoque int")
    batches = [[(1, 1, 5), (1, 2, 9), (2, 1, 6)], [(1, 3, 4), (1, 4, 2), (2, 2, 5)], [(1, 5, 1), (3, 1, 1)]]
    for lines in batches:
        spark.createDataFrame(lines, "livro bigint, vez bigint, qtd bigint").coalesce(1).write.mode("append").parquet(source)
        stream = jobs.landing_stream(spark, source, "livro bigint, vez bigint, qtd bigint", fmt="parquet")
        jobs.sales(stream, shelf, "livro", "vez", "qtd", out, check)
    got = {(r.livro, r.vez): r.motivo for r in spark.read.parquet(f"{out}/decided").collect()}
    low = "estoque_insuficiente"
    assert got == {(1, 1): None, (1, 2): low, (2, 1): low, (1, 3): None, (1, 4): low, (2, 2): None, (1, 5): None, (3, 1): "livro_inexistente"}


def test_stream_state_keeps_a_batch_to_its_own_rows(spark, tmp_path):
    """Fifteen batches and a restart: none reads more than its file and the state of its keys, and the stock is right."""
    import random

    rng, left, want = random.Random(4), {k: 60 for k in range(5)}, {}
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    shelf = spark.createDataFrame(list(left.items()), "livro bigint, estoque int")
    for k in range(15):
        lines = [(rng.randrange(6), 40 * k + i, rng.choice([None, 0, 1, 2, 5, 30])) for i in range(40)]
        for book, seq, n in lines:
            if book not in left:
                want[(book, seq)] = ("livro_inexistente", None)
            elif not n:
                want[(book, seq)] = ("quantidade_invalida", None)
            else:
                want[(book, seq)] = (None if n <= left[book] else "estoque_insuficiente", left[book])
                left[book] -= n if n <= left[book] else 0
        spark.createDataFrame(lines, "livro bigint, vez bigint, qtd bigint").coalesce(1).write.parquet(f"{source}/{k:02d}")
        if k in (8, 14):
            stream = jobs.landing_stream(spark, source, "livro bigint, vez bigint, qtd bigint", files_per_batch=1, fmt="parquet")
            for batch in jobs.sales(stream, shelf, "livro", "vez", "qtd", out, check):
                assert batch["numInputRows"] in (0, 40) and batch["stateOperators"][0]["numRowsTotal"] <= 6
    got = {(r.livro, r.vez): (r.motivo, r.estoque_antes) for r in spark.read.parquet(f"{out}/decided").collect()}
    assert got == want and spark.read.parquet(f"{out}/decided").select("_batch").distinct().count() == 15


def test_a_batch_goes_through_its_state_once(spark, tmp_path):
    """Events of two batches, copies among them: few parts of state, one update for each event, exact numbers of copies."""
    landing, out, check = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "check")
    schema = "event_id bigint, session_id string, customer_id bigint, product_id bigint, order_id bigint, event_type string, event_at string, device string, source string"
    line = lambda i, k: (i, "s", 2**60 + 1 if i % 2 else None, None, None, "view", f"2024-01-0{k} 10:00:00", "app", "web")
    people, goods = spark.createDataFrame([(2**60 + 1,)], "customer_id bigint"), spark.createDataFrame([], "product_id bigint")
    given = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        for k, ids in ((1, [*range(30), 3, 3, None]), (2, [3, 5, 5, 40, None])):
            spark.createDataFrame([line(i or 0, k) if i is not None else (None, *line(0, k)[1:]) for i in ids], schema).coalesce(1).write.json(f"{landing}/events/{k}")
            stream = jobs.landing_stream(spark, f"{landing}/events", schema)
            progress = [b for b in jobs.quality_split(stream, people, goods, landing, out, check, RUN) if b["numInputRows"]]
            state = progress[-1]["stateOperators"][0]
            assert state["numShufflePartitions"] <= 2 * spark.sparkContext.defaultParallelism
            assert state["numRowsTotal"] == (31 if k == 1 else 32) and state["numRowsUpdated"] <= len(set(ids))
            assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)
    got = spark.read.parquet(f"{out}/checked")
    turns = sorted((r.event_id, r.ocorrencia) for r in got.collect() if r.event_id in (3, 5, 40))
    assert turns == [(3, 1), (3, 2), (3, 3), (3, 4), (5, 1), (5, 2), (5, 3), (40, 1)]
    assert [r.ocorrencia for r in got.filter("event_id is null").orderBy("ocorrencia").collect()] == [1, 2]
    assert {r.customer_id for r in got.filter("event_id % 2 = 1").collect()} == {2**60 + 1}


def test_copies_are_counted_without_python(spark, tmp_path, rows):
    """Three batches and a restart: Spark's own aggregation counts an event's copies, and only repeated events leave it."""
    schema = "event_id bigint, session_id string, customer_id bigint, product_id bigint, order_id bigint, event_type string, event_at string, device string, source string"
    batches = [[*range(20), None, 7, 7, *[8] * 300], [7, 7, 8, None, None, 30, 31, 31], [31, 8, 30, 99, None, *range(5)]]
    nobody = spark.createDataFrame([], "customer_id bigint, product_id bigint")

    landing, out, check = (str(tmp_path / x) for x in ("landing", "out", "check"))
    operators = set()
    for k, ids in enumerate(batches):
        lines = [(i, "s", None, None, None, "view", f"2024-01-0{k + 1} 10:00:00", "app", "web") for i in ids]
        spark.createDataFrame(lines, schema).coalesce(1).write.json(f"{landing}/events/{k}")
        if k:  # the first start finds two files, each a batch of its own
            stream = jobs.landing_stream(spark, f"{landing}/events", schema, files_per_batch=1)
            done = jobs.quality_split(stream, nobody.select("customer_id"), nobody.select("product_id"), landing, out, check, RUN)
            operators |= {b["stateOperators"][0]["operatorName"] for b in done if b["numInputRows"]}
    assert operators == {"stateStoreSave"}
    so_far = rows(spark.read.parquet(f"{out}/counted").filter("_earlier is not null").select("_batch", "event_id", "_earlier"))
    got = rows(spark.read.parquet(f"{out}/checked").select("_batch", "event_id", "ocorrencia"))
    order = lambda t: tuple((x is not None, str(x)) for x in t)
    assert so_far == sorted(
        [(0, 7, 3), (0, 8, 301), (1, None, 3), (1, 7, 5), (1, 8, 302), (1, 31, 2), (2, None, 4), (2, 8, 303), (2, 30, 2), (2, 31, 3), *((2, i, 2) for i in range(5))],
        key=order,
    )
    want, seen = [], {}
    for k, ids in enumerate(batches):
        for i in ids:
            seen[i] = seen.get(i, 0) + 1
            want.append((k, i, seen[i]))
    assert got == sorted(want, key=order)


def test_settled_amounts_are_exact(spark, tmp_path):
    """A missing amount in a book's batch makes no decimal of the others; books that have no stock and no key are refused."""
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    shelf = spark.createDataFrame([(1, 2**55)], "livro bigint, estoque bigint")
    lines = [(1, 1, 2**54 + 1), (1, 2, None), (1, 3, 2**54 - 1), (1, 4, 1), (None, 1, 1)]
    spark.createDataFrame(lines, "livro bigint, vez bigint, qtd bigint").coalesce(1).write.parquet(source)
    jobs.sales(jobs.landing_stream(spark, source, "livro bigint, vez bigint, qtd bigint", fmt="parquet"), shelf, "livro", "vez", "qtd", out, check)
    got = {(r.livro, r.vez): (r.qtd, r.motivo, r.estoque_antes) for r in spark.read.parquet(f"{out}/decided").collect()}
    assert got == {
        (1, 1): (2**54 + 1, None, 2**55), (1, 2): (None, "quantidade_invalida", None), (1, 3): (2**54 - 1, None, 2**54 - 1),
        (1, 4): (1, "estoque_insuficiente", 0), (None, 1): (1, "livro_inexistente", None),
    }


def test_validation_needs_all_checks(spark):
    ok = spark.createDataFrame([("a", True, "")], "verificacao string, ok boolean, detalhe string")
    validate.require(ok)
    with pytest.raises(validate.FailedChecks):
        validate.require(ok.unionByName(spark.createDataFrame([("b", None, "?")], ok.schema)))
