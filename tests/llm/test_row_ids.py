"""Rows that an explode, a join or a union multiplied come out once each, with findings of their own."""

import pytest
from pyspark.sql import functions as F

from quartzo.llm.common import identified
from quartzo.llm.contamination import decontaminate
from quartzo.llm.licenses import scan
from quartzo.llm.mixing import mix
from quartzo.llm.quality import judge

TEXTS = ["cc by", "x y z", "all rights reserved by one two three four five six seven eight nine ten"]


@pytest.fixture(params=["explode", "join", "union"])
def frame(spark, tmp_path, request):
    spark.range(12).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source")).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    if request.param == "explode":
        return docs.withColumn("text", F.explode(F.array(*map(F.lit, TEXTS))))
    if request.param == "join":
        return docs.join(spark.createDataFrame([("s", t) for t in TEXTS], "source string, text string"), "source")
    parts = [docs.withColumn("text", F.lit(t)) for t in TEXTS]
    return parts[0].union(parts[1]).union(parts[2])


def test_ids_are_unique(frame):
    assert identified(frame, "row").select("row").distinct().count() == 36


def test_findings_are_each_rows_own(spark, frame):
    got = {(r.doc_id, r.text, r.n_words, r.n_base) for r in scan(frame).collect()}
    assert got == {(i, t, len(t.split()), int(t != TEXTS[1])) for i in range(12) for t in TEXTS}
    items = spark.createDataFrame([(1, TEXTS[2])], "item_id long, text string")
    got = [(r.doc_id, r.text, r.n_words, r.contaminated) for r in decontaminate(frame, items).collect()]
    assert sorted(got) == sorted((i, t, len(t.split()), t == TEXTS[2]) for i in range(12) for t in TEXTS)
    got = [(r.doc_id, r.text, r.n_words) for r in judge(frame).collect()]
    assert sorted(got) == sorted((i, t, len(t.split())) for i in range(12) for t in TEXTS)


def test_mixing_takes_rows_one_by_one(frame):
    size = F.size(F.split("text", " ")).cast("long")
    rows = mix(frame, "source", size, F.xxhash64("doc_id", "text"), undrawn=True)
    each = rows.groupBy("mix_row", "doc_id", "text").agg(F.count("copy").alias("n")).collect()
    assert len(each) == 36 and len({r.mix_row for r in each}) == 36 and all(r.n == 1 for r in each)
