import random

import pytest
from test_contamination import plain
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "Shard"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Shard string"
SOUNDS = {"xx": "ba be bo du ka".split(), "yy": "schi unge lich tz ver".split()}


def words(rng, lang, n):
    return ["".join(rng.choices(SOUNDS[lang], k=rng.randrange(1, 5))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, "xx", 30))) for i in range(4)]
    rows = []
    for i in range(70):
        lang = "xy"[i % 2] * 2
        body = words(rng, lang, rng.randrange(40, 120))
        if i % 10 == 3:
            body[5:5] = items[i % 4][1].split()
        rows.append((i, " ".join(body), lang if i % 9 else None, ["a", "b", None][i % 3]))
    rows += [(100 + i, rows[i][1], "xx", "a") for i in range(10)] + [(0, rows[0][1], "xx", "a")] * 2
    rows += [(200, None, None, "a"), (201, "", "xx", None), (202, "123 ...", None, "b"), (None, rows[1][1], None, "b"), (None, " ".join(words(rng, "yy", 60)), "yy", "b")]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, len(r[1] or ""), "s") for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_every_stage_against_a_plain_one(spark, corpus, tmp_path):
    path, rows, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        assert out.columns == (COLUMNS if k < 4 else [*COLUMNS[:-1], "shard", "slot"])
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "language ID":
            want = [(i, t) for i, t in kept if t and any(c.isalpha() for c in t)]
            assert sorted(got, key=str) == sorted(want, key=str)
        elif name == "SimHash near-dedup":
            fps = [plain_fingerprint(t) for _, t in kept]
            groups = plain_components(list(range(len(kept))), fps)
            first = {}
            for g, (i, _) in zip(groups, kept):
                first.setdefault(g, []).append(i)
            want = [min((i for i in ids if i is not None), default=None) for ids in first.values()]
            assert sorted((i for i, _ in got), key=str) == sorted(want, key=str)
        elif name == "benchmark decontamination":
            want = [(i, t) for i, t in kept if not plain(t, items)[3]]
            assert sorted(got, key=str) == sorted(want, key=str) and len(want) < len(kept)
        elif name.startswith("mixing"):
            assert set(got) <= set(kept) and max(got.count(x) for x in got) <= 3
        else:
            assert sorted(got, key=str) == sorted(kept, key=str)
            for s in {r.shard for r in docs.collect()}:
                slots = sorted(r.slot for r in docs.collect() if r.shard == s)
                assert slots == list(range(len(slots)))
        kept = got


def test_run_and_empty_table(spark, corpus, tmp_path):
    path, _, items = corpus
    assert corpus_pipeline.run(spark, path).columns == [*COLUMNS[:-1], "shard", "slot"]
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
