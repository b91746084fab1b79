import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartzo.llm import quality, queries
from quartzo.llm.licenses import APART, BASE, SEEN, WORDINGS, needed, scan
from quartzo.llm.lines import drop_boilerplate, host_of, lines_of
from quartzo.llm.quality import judge


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_license_places(spark):
    texts = [(1, None), (2, ""), (3, "CC BY"), (4, "cc-by. cc by cc\nby All Rights reserved"), (5, "the GNU General Public\tLicense, version 3 general public licenses"),
             (6, "cc"), (7, "cc byé cc by"), (7, "cc byé cc by"), (None, "all rights all rights reserved"), (8, "x " * 40_000 + "general public license"),
             (9, "Licensed under the Apache License, Version 2.0."), (10, "licensed under the very Apache License Version 2.0"), (11, "under the the license")]
    df = spark.createDataFrame([(i, t, "y", 2) for i, t in texts], "doc_id long, text string, labels string, row int")
    out = scan(df)
    assert out.columns == ["doc_id", "text", "row", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out.collect()), key=str)
    want = []
    for i, t in texts:
        ws, places, labels = words(t), [], set()
        for phrase, label in BASE:
            p = phrase.split()
            for a in range(len(ws)):
                if ws[a : a + len(p)] == p:
                    places.append(a)
                    labels.add(label)
        want.append((i, len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    assert got == sorted(want, key=str)
    by = {r.doc_id: r for r in out.collect()}
    assert by[9].labels == "apache" and by[9].score == 1 and (by[9].spans[0].start, by[9].spans[0].end) == (0, 8)
    assert by[10].labels == "apache" and 0.75 <= by[10].score < 1
    assert by[11].labels == "" and by[11].score == 0 and by[11].spans == [] and by[4].labels == "cc-by,reserved"
    assert scan(df.limit(0)).count() == 0


def plain_scan(text):
    """Labels and score by trying every chain of pairs from every place."""
    ws = words(text)
    pairs, spans, base = list(zip(ws, ws[1:])), [], set()
    for phrase, label in BASE:
        p = phrase.split()
        base |= {label for a in range(len(ws)) if ws[a : a + len(p)] == p}
    for t, (phrase, label) in enumerate(WORDINGS):
        p, needs = phrase.split(), needed(phrase, label)
        steps = list(zip(p, p[1:]))
        hits = [(a, q) for a, g in enumerate(pairs) for q, s in enumerate(steps) if g == s]
        longest = max(len(w.split()) for w, _ in WORDINGS)
        for first in hits:
            chains = [(first,)]
            for chain in chains:
                chains += [(*chain, h) for h in hits if h[0] > chain[-1][0] and h[1] > chain[-1][1] and abs((h[0] - h[1]) - (first[0] - first[1])) <= APART]
            best = max(chains, key=lambda c: (len(c), -c[-1][0], c))
            share = len(best) / len(steps)
            places = []
            for n in needs:
                fits = [a for a, w in enumerate(ws) if w == p[n] and first[0] <= a <= first[0] + longest + APART and abs((a - n) - (first[0] - first[1])) <= APART and all((q < n) == (x < a) for x, q in best)]
                places.append(min(fits, default=None))
            if share >= SEEN and None not in places:
                spans.append((-share, -len(steps), first[0], len(BASE) + t, max([best[-1][0] + 2, *(a + 1 for a in places)]), label))
    kept = []
    for s in sorted(spans):
        if all(k[2] >= s[4] or s[2] >= k[4] for k in kept):
            kept.append(s)
    return ",".join(sorted(base | {s[5] for s in kept})), max([-s[0] for s in kept] + [1.0] * bool(base), default=0.0)


def test_license_labels_and_score_by_brute_force(spark):
    rng = random.Random(11)
    texts = ["", None]
    for _ in range(250):
        out = []
        for _ in range(rng.randrange(1, 4)):
            part = rng.choice(WORDINGS + BASE)[0].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(part))
                part = rng.choice([part[:at] + part[at + 1 :], part[:at] + [rng.choice("x under by nc sa the license 2".split())] + part[at:], part])or ["x"]
            out += part + ["filler"] * rng.randrange(3)
        texts.append(" ".join(out))
    got = scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.labels, pytest.approx(r.score)) == plain_scan(r.text), r.text


def test_license_base_columns_by_sql(spark):
    """Whole tables against SQL that finds the phrases in the joined words."""
    import duckdb

    folder = "/root/testdata/sf0.01"
    sql = """WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS ws FROM 'FOLDER/documents.parquet'),
             p AS (SELECT doc_id, unnest(range(len(ws))) AS i, ws FROM d),
             f AS (SELECT doc_id, i, label FROM p JOIN (VALUES PHRASES) v(phrase, label) ON ws[i + 1:i + len(phrase)] = phrase)
             SELECT d.doc_id, len(ws), count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id, len(ws)"""
    phrases = ", ".join(f"({p.split()}, '{label}')" for p, label in BASE)
    want = duckdb.sql(sql.replace("FOLDER", folder).replace("PHRASES", phrases)).fetchall()
    got = queries.op4_license_scans(spark, folder).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_license_wordings_are_told_apart(spark):
    texts = {
        "Licensed under CC BY-NC": "cc-by,cc-by-nc", "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa", "licensed under cc by": "cc-by", "licensed under cc by 4.0 only": "cc-by",
        "licensed under cc by 4.0 nc": "cc-by,cc-by-nc", "licensed under cc by a b c d nc": "cc-by", "nc licensed under cc by": "cc-by", "licensed under cc by-nc-sa": "cc-by,cc-by-nc",
        "licensed under cc by nc, parts are licensed under cc by sa": "cc-by,cc-by-nc,cc-by-sa", "sa " * 30 + "licensed under cc by": "cc-by",
        # pairs of a wording that recur all over a text, or stand against its order, make no span
        " ".join(f"{a} x{i} y{i}" for i in range(20) for a in ("licensed under", "under the", "the apache", "apache license", "license version", "version 2", "2 0")): "",
        "license version 2 0 apache license the apache under the licensed under": "",
        "permission is hereby granted free charge to any person obtaining a copy of this fine software permission is hereby": "mit", None: "",
    }
    out = scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).collect()
    assert {r.text: r.labels for r in out} == texts
    for r in out:
        assert all(0 <= s.start < s.end <= r.n_words and s.end - s.start <= 15 + 3 for s in r.spans)


def plain_statistics(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t", "one", "a b c", "a b c a b c", "a b c x a b c d", "a a a a a", "É é\né é\né é", "x\n\n x\nx\nx\r\nx", "#*$%&|<> ## a", "a\x1cb\x85c d",
         "a b a b a b q", " ".join(f"w{i}" for i in range(200)), "same line here\n" * 30, "p q r " + " ".join(f"v{i}" for i in range(60)) + " p q r"]


@pytest.mark.parametrize("bits", [24, 60, 2])
def test_statistics(spark, bits, monkeypatch):
    """With 60 or 2 bits for places, hashes of different windows collide or places don't fit; results stay exact."""
    monkeypatch.setattr(quality, "POS_BITS", bits)
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices("abcd", k=rng.randrange(3, 60))) for _ in range(25)] + [" ".join(rng.choices("abcdefgh", k=900))]
    df = spark.createDataFrame([(i, t, "l", "s", True) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, kept boolean")
    got = {r.doc_id: r for r in judge(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, want = got[i], plain_statistics(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_outliers_of_each_group(spark):
    rng = random.Random(3)
    rows = []
    for g in range(3):
        for i in range(150):
            rows.append((len(rows), " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(60, 200))), "xy"[g % 2], f"s{g}" if g else None))
    noisy = [(10_000 + i, " ".join(rng.choice("#$%&") * 6 + "abc"[i % 3] + str(j) for j in range(80)), "x", None) for i in range(30)]
    small = [(20_000 + i, " ".join(f"q{j}" for j in range(60 + i)), "x", "few") for i in range(5)]
    df = spark.createDataFrame(rows + noisy + small, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in judge(df).collect()}
    assert all(got[i].kept for i, *_ in rows) and not any(got[i].kept for i, *_ in noisy)
    assert all(got[i].kept and got[i].distance is None for i, *_ in small)
    again = {r.doc_id: r.kept for r in judge(df.repartition(5)).collect()}
    assert again == {i: r.kept for i, r in got.items()}


def test_small_groups_are_judged_by_wider_ones(spark):
    rng = random.Random(4)

    def plain():
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(60, 200)))

    def noisy():
        return " ".join(rng.choice("#$%&") * 6 + str(rng.randrange(10**6)) for _ in range(80))

    # every source of x is small, its texts are many; y is small altogether
    rows = [("x", f"s{i % 9}", plain(), True) for i in range(180)] + [("x", f"s{i}", noisy(), False) for i in range(9)]
    rows += [("y", None, plain(), True) for _ in range(6)] + [(None, "s1", noisy(), False), ("y", "s1", noisy(), False), ("y", "s1", "one", None), ("y", "s1", None, None)]
    schema = "doc_id long, lang string, source string, text string, good boolean"
    for part in (rows, rows[154:180] + rows[186:]):  # of the second, even all texts are fewer than a source must have
        for r in judge(spark.createDataFrame([(i, *x) for i, x in enumerate(part)], schema)).collect():
            assert r.distance is None and (r.wider_distance is not None) == (r.n_words > 0), r.doc_id
            assert r.kept == bool(r.good), r.doc_id
    assert [r.kept for r in judge(spark.createDataFrame([(1, "z", "s", plain(), True)], schema)).collect()] == [True]


def test_distance_is_mahalanobis(spark):
    rng = np.random.default_rng(0)
    dims = list(quality.FLOORS)
    x = rng.multivariate_normal(np.zeros(5), np.diag([1, 2, 1, 1, 3]) + 0.5, 400)
    rows = spark.createDataFrame([(i, 1, *map(float, v)) for i, v in enumerate(x)], "row int, g int, " + ", ".join(f"{d} double" for d in dims))
    fit = quality._estimate(rows, dims)
    got = {r.row: r.d2 for r in rows.join(fit, "g").select("row", quality._squared(dims).alias("d2")).collect()}
    centred = x - x.mean(0)
    want = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(np.cov(x.T, bias=True)), centred)
    assert np.allclose([got[i] for i in range(400)], want)


def test_concentrated_estimate_has_the_smallest_determinant(spark):
    """Against plain concentration steps from many random subsets: no start of theirs ends on a clearly smaller determinant."""
    rng = np.random.default_rng(5)
    dims = list(quality.FLOORS)
    good = rng.multivariate_normal(np.zeros(5), 4 * np.eye(5) + 3, 300)
    x = np.vstack([good, rng.normal(14, 0.7, (60, 5))])  # a tight far cluster that medians alone don't give away
    rows = [(i, ("l", "l", "s"), i % quality.PARTS, *map(float, v)) for i, v in enumerate(x)]
    schema = "row long, g struct<level: string, lang: string, source: string>, part int, " + ", ".join(f"{d} double" for d in dims)
    (fit,) = quality._concentrated(spark.createDataFrame(rows, schema), dims).collect()
    keep = int(np.ceil(quality.CORE * len(x)))

    def determinant(core):
        return np.linalg.slogdet(np.cov(x[core].T, bias=True))[1] / 2

    def concentrated(core):
        while True:
            off = x - x[core].mean(0)
            near = np.sort(np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(np.cov(x[core].T, bias=True)), off))[:keep])
            if np.array_equal(near, core):
                return core
            core = near

    best = min((concentrated(np.sort(rng.choice(len(x), 30, replace=False))) for _ in range(60)), key=determinant)
    # bins let the core take a few texts more than its share
    assert fit.spread < determinant(best) + 0.15
    assert np.abs(np.array([fit[f"m_{d}"] for d in dims]) - x[best].mean(0)).max() < 0.3


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert judge(df).count() == 0


def test_hosts_and_lines(spark):
    urls = [("http://A.b.c/x?y", "a.b.c"), ("https://u:p@h.d:80#z", "h.d"), ("nonsense", None), (None, None), ("ftp://", None), ("x+y://h", "h")]
    df = spark.createDataFrame(urls, "u string, h string")
    assert all(r.h == r.got for r in df.withColumn("got", host_of(F.col("u"))).collect())
    html = '<html><style>p{}</style><SCRIPT>a="</p>";</SCRIPT><p>one <b>two</b>\n three<!-- no\n --></p><br> </html>'
    (r,) = spark.createDataFrame([(html,)], "h string").select(lines_of(F.col("h")).alias("x")).collect()
    assert r.x == ["one", "two", "three"]


def test_boilerplate_of_a_site(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        host = ["a.com", "b.com", None][i % 3]
        own = [f"own {i} {j}" for j in range(rng.randrange(4))]
        shared = ["menu", "menu"] * (i % 2) + ["footer"] * (i % 7 != 0) + ["rare"] * (i < 6)
        rows.append((i, f"http://{host}/{i}" if host else "??", "".join(f"<p>{x}</p>" for x in own + shared)))
    rows += [(100, "http://one.com/", "<p>alone</p>"), (101, "http://n.com/", None), (101, "http://n.com/", None), (102, "http://n.com/", "<p>y</p>")]
    rows += [(200 + i, "http://same.com/", "<p>x</p><p>x</p>") for i in range(4)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, host int, lines string")
    out = drop_boilerplate(df)
    assert out.columns == ["page_id", "url", "html", "lines", "host", "n_lines", "n_dropped", "kept_text"]
    pages = [(i, u.split("/")[2] if "//" in u else None, re.findall("<p>(.*?)</p>", h or "")) for i, u, h in rows]
    hosts = {}
    for _, host, ls in pages:
        hosts.setdefault(host, []).append(set(ls))
    want = []
    for i, host, ls in pages:
        seen = lambda x: sum(x in p for p in hosts[host])
        kept = [x for x in ls if not (seen(x) >= 3 and seen(x) > 0.2 * len(hosts[host]))]
        want.append((i, host, len(ls), len(ls) - len(kept), "\n".join(kept)))
    assert sorted(((r.page_id, r.host, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()), key=str) == sorted(want, key=str)
    assert drop_boilerplate(df.limit(0)).count() == 0
