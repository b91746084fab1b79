import random
import re

import pytest

from quartzo.llm import contamination
from quartzo.llm.contamination import decontaminate


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, items):
    ws = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        iw = words(item)
        n = min(13, len(iw))
        for s in range(len(iw) - n + 1) if n else ():
            for i in range(len(ws) - n + 1):
                if ws[i : i + n] == iw[s : s + n]:
                    hit |= set(range(i, i + n))
                    found.add(item_id)
    return len(ws), len(hit), sorted(str(i) for i in found if i is not None), len(hit) > 0 and 20 * len(hit) >= len(ws)


def check(spark, docs, items):
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, items string, row int")
    right = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate(left, right)
    assert out.columns == ["doc_id", "text", "row", "n_words", "n_hit", "items", "near_items", "contaminated"]
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()), key=str)
    assert got == sorted(((i, *plain(t, items)) for i, t in docs), key=str)
    return out


@pytest.mark.parametrize("block", [256, 7, 1])
def test_against_brute_force(spark, block, monkeypatch):
    """Items reach over several blocks of a text where blocks are short."""
    monkeypatch.setattr(contamination, "BLOCK", block)
    rng = random.Random(4)
    vocabulary = ["the", "of", "a", "É", "é", "x1"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 5, 13, 14, 30, 50]))) for i in range(12)] + [(3, text(20)), (None, text(15)), (50, None), (51, " .. "), (52, "the the the the")]
    docs = [(i, text(rng.randrange(120))) for i in range(30)]
    for i, (_, item) in enumerate(items):
        docs.append((100 + i, f"{text(20)}. {(item or '').upper()}! {text(300 if i % 2 else 10)}"))
        cut = words(item)
        docs.append((200 + i, " ".join(cut[:12] + ["changed"] + cut[12:])))
    docs += [(7, None), (7, ""), (None, items[0][1]), (8, docs[30][1]), (8, docs[30][1]), (9, "the " * 5000)]
    check(spark, docs, items)


def test_proximity(spark):
    item = " ".join(f"rare{i}" for i in range(30))
    changed = item.split()
    del changed[9]
    changed.insert(19, "more")
    out = check(spark, [(1, " ".join(changed)), (2, "nothing here"), (3, item)], [(77, item)])
    assert {r.doc_id: r.near_items for r in out.collect()} == {1: ["77"], 2: [], 3: ["77"]}


def test_empty_tables(spark):
    check(spark, [], [(1, "a b c")])
    check(spark, [(1, "a b c"), (2, None)], [])


def test_long_text_quotes_many_items(spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"q{i}x{j}" for j in range(13 + i))) for i in range(40)]
    parts = []
    for _, item in items:
        parts += [" ".join(rng.choices(["the", "of", "and"], k=rng.randrange(200, 400))), item]
    check(spark, [(1, " ".join(parts * 2)), (2, " ".join(parts[:9]))], items)
