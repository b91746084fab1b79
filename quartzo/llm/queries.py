"""The registered queries of this subpackage, and SQL that must give the same rows where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.llm import lm
from quartzo.llm.chat import branches, format_branches, reply_chains, turns, under_mask
from quartzo.llm.common import BLANKS, blank_words, stored, table
from quartzo.llm.contamination import decontaminate
from quartzo.llm.language import fit_languages, identify
from quartzo.llm.licenses import scan
from quartzo.llm.lines import PAGES, RATIO, drop_boilerplate
from quartzo.llm.merkle import leaf, manifest, refold
from quartzo.llm.mixing import mix
from quartzo.llm.quality import judge
from quartzo.llm.sharding import shard
from quartzo.llm.simhash import simhash_components
from quartzo.llm.toxicity import fit_toxicity, score_toxicity
from quartzo.llm.trie import prefix_trie, step_digest
from quartzo.operators.scan import number

Query = Callable[[SparkSession, str], DataFrame]


def byte_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def n_blank_words(text: str = "text") -> Column:
    return F.size(blank_words(F.col(text))).cast("long")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", byte_size().alias("size"), F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("text_key"))
    rows = shard(docs, 8, F.col("size"), F.col("text_key"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_boilerplate(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "host", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = rf"""
WITH raw AS (
  SELECT row_number() OVER () AS r, page_id,
    nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', ''), '') AS host,
    string_split(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(10), 'g'),
      '<[^>]*>|[\t\r]+', chr(10), 'g'), chr(10)) AS parts
  FROM pages
), page AS (SELECT r, page_id, host, [trim(x, ' ') FOR x IN parts IF trim(x, ' ') <> ''] AS ls FROM raw),
total AS (SELECT host, count(*) AS n FROM page GROUP BY host),
line AS (SELECT r, host, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM page),
bad AS (
  SELECT c.host, l FROM (SELECT host, l, count(DISTINCT r) AS n FROM line GROUP BY host, l) c JOIN total t ON c.host IS NOT DISTINCT FROM t.host
  WHERE c.n >= {PAGES} AND c.n > {RATIO} * t.n
), kept AS (
  SELECT r, string_agg(l, chr(10) ORDER BY i) AS t, count(*) AS n FROM line WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.host IS NOT DISTINCT FROM line.host AND b.l = line.l)
  GROUP BY r
)
SELECT page_id, host, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM page LEFT JOIN kept USING (r)
"""


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def fold(doc_id: str = "doc_id") -> Column:
    """0 to 4 by the id's text; the rows of fold 0 are held out. A null id is in no fold."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def held_out() -> Column:
    return F.coalesce(fold() == 0, F.lit(False)).alias("held_out")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated")


OP6_SQL = r"""
WITH split AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 'i', item_id, row_number() OVER (), text FROM benchmark
), word AS (
  SELECT kind, id, r, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM split
), sized AS (SELECT *, len(ws) AS n FROM word),
probe AS (SELECT DISTINCT least(13, n) AS w FROM sized WHERE kind = 'i' AND n > 0),
item AS (
  SELECT id, least(13, n) AS w, unnest([array_to_string(ws[i:i + least(13, n) - 1], ' ') FOR i IN range(1, n - least(13, n) + 2)]) AS phrase
  FROM sized WHERE kind = 'i' AND n > 0
), spot AS (SELECT r, ws, w, unnest(range(1, n - w + 2)) AS i FROM sized, probe WHERE kind = 'd' AND n >= w),
hit AS (SELECT DISTINCT r, i, a.w, id FROM (SELECT r, w, i, array_to_string(ws[i:i + w - 1], ' ') AS phrase FROM spot) a JOIN item USING (w, phrase)),
place AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + w)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(id AS VARCHAR) AS id FROM hit WHERE id IS NOT NULL) GROUP BY r)
SELECT d.id AS doc_id, CAST(d.n AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= d.n AS contaminated
FROM sized d LEFT JOIN place USING (r) LEFT JOIN found USING (r) WHERE d.kind = 'd'
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix(docs, "source", n_blank_words(), F.xxhash64("doc_id", "text"), undrawn=True)
    # a copy counts where the tree has put its block: a row has three at most
    rows = mixed.groupBy("mix_row", "doc_id", "mix_size", "source_size", "target").agg(F.array_sort(F.collect_list("mix_shard")).alias("shards"))
    taken = (F.size("shards") * F.col("mix_size")).alias("taken")
    return rows.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", taken, "shards")


#: The conversation that the contract adds.
ESCAPES = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", ESCAPES), (-7, 1, "assistant", ESCAPES)], given.schema)
    messages = reply_chains(given.union(extra))
    out = stored(format_branches(branches(messages), messages))  # what follows is read back from it
    out = out.withColumns({"back": turns(F.col("formatted")), "learned": under_mask(F.col("formatted"), F.col("mask"))})
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH given AS (
  SELECT conv_id::BIGINT AS conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), said AS (SELECT conv_id, turn, role AS ro, text AS te, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, ro NULLS FIRST, te NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, ro NULLS FIRST, te NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\#<:]', '', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(fold() != 0))
    scored = score_toxicity(docs, model, spans=False)
    return scored.select("doc_id", held_out(), F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(fold() != 0))
    return identify(docs.drop("lang"), model).select("doc_id", held_out(), "lang_pred", "score")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out")
    model = lm.fit(docs.where(~out), F.col("doc_id"))
    return lm.score(docs, model, keep=["doc_id"]).select("doc_id", out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    # of every seventh document or so the leaf after tampering
    touched = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf(*fields(F.col("n_chars") + 1)))
    rows = manifest(docs.withColumn("tampered", touched), fields(F.col("n_chars")), "lang", "doc_id", keep=["doc_id", "tampered"])
    rows = rows.withColumn("folded_root", refold(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    steps = f"flatten([[ord(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split({text}, '')])"
    return f"xor(list_reduce({steps}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    fields = [f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(fields)})"


OP12_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '0') AS g, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS touched
  FROM documents
), leaf AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM raw
), node AS (
  SELECT g, 0 AS lev, p, n, leaf AS h FROM leaf
  UNION ALL SELECT g, lev + 1, p // 2, (min(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM node WHERE n > 1 GROUP BY g, lev, p // 2
), sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lev, p, n, subroot AS h FROM sub UNION ALL SELECT lev + 1, p // 2, (min(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY lev, p // 2
), turn AS (  -- every row's own node on every level that has more than one
  SELECT r, a.lev AS step, a.g, a.lev, a.p, true AS low FROM leaf JOIN node a ON a.g = leaf.g AND a.n > 1 AND a.p = leaf.p >> a.lev
  UNION ALL SELECT r, 1000 + a.lev, leaf.g, a.lev, a.p, false FROM leaf JOIN sub USING (g) JOIN top a ON a.n > 1 AND a.p = sub.p >> a.lev
), side AS (
  SELECT r, step, t.p % 2 AS slot, coalesce(node.h, top.h, '') AS h FROM turn t
  LEFT JOIN node ON t.low AND node.g = t.g AND node.lev = t.lev AND node.p = xor(t.p, 1) LEFT JOIN top ON NOT t.low AND top.lev = t.lev AND top.p = xor(t.p, 1)
), path AS (
  SELECT r, sha256(string_agg(h, '' ORDER BY step)) AS proof, list(CASE WHEN slot = 1 THEN h ELSE '' END ORDER BY step) AS lefts, list(CASE WHEN slot = 0 THEN h ELSE '' END ORDER BY step) AS rights FROM side GROUP BY r
), fold AS (
  SELECT r, 0 AS k, touched AS h FROM leaf
  UNION ALL SELECT fold.r, k + 1, sha256(lefts[k + 1] || h || rights[k + 1]) FROM fold JOIN path ON path.r = fold.r AND k < len(lefts)
), last AS (SELECT r, arg_max(h, k) AS folded FROM fold GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaf JOIN sub USING (g) JOIN last USING (r) LEFT JOIN path USING (r), (SELECT h AS root FROM top WHERE n = 1)
"""


#: Conversations that share a first one, and the remainders that say how many of its turns they take.
FAMILY, TAKEN = 20, 4


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").where("conv_id is not null")  # without an id a turn is in no conversation
    turns = given.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long"), step_digest(F.col("role"), F.col("text")).alias("step"), n_blank_words().alias("words"))
    turns = stored(number(turns, ["conv"], ["turn", "step"], "k").drop("turn"))
    taken = F.crc32(F.col("conv").cast("string")) % TAKEN
    convs = turns.where("k = 1").select("conv", taken.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    heads = turns.where(F.col("k") < TAKEN).withColumnRenamed("conv", "base")
    first = convs.join(heads, "base").where("k <= h").select("conv", F.struct(F.lit(0).alias("own"), "k").alias("by"), "step", "words")
    rest = turns.where(F.col("k") > taken).select("conv", F.struct(F.lit(1).alias("own"), "k").alias("by"), "step", "words")
    return prefix_trie(first.union(rest), convs.select("conv"))


OP13_SQL = rf"""
WITH told AS (
  SELECT conv_id::BIGINT AS c, turn, coalesce(text, '') AS text, coalesce(role, '') AS role, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL
), turned AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, x) AS k, len([w FOR w IN regexp_split_to_array(text, '{BLANKS}') IF w <> '']) AS w FROM told),
conv AS (SELECT c, {crc32_sql("c::VARCHAR")} % {TAKEN} AS h FROM (SELECT DISTINCT c FROM told)),
built AS (
  SELECT conv.c, 0 AS own, k, x, w FROM conv JOIN turned t ON t.c = conv.c - conv.c % {FAMILY} AND k <= h
  UNION ALL SELECT c, 1, k, x, w FROM conv JOIN turned USING (c) WHERE k > h
), line AS (SELECT c, coalesce(list(x ORDER BY own, k) FILTER (x IS NOT NULL), []) AS xs, coalesce(list(w ORDER BY own, k) FILTER (x IS NOT NULL), []) AS ws FROM conv LEFT JOIN built USING (c) GROUP BY c),
part AS (SELECT c, d, len(xs) = d AS ends, array_to_string(xs[:d], '') AS key, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM (SELECT *, unnest(range(len(xs) + 1)) AS d FROM line)),
node AS (
  SELECT key, d, min(c) AS c, count(*) AS n, min(w) AS w, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends FROM part GROUP BY key, d
), child AS (SELECT left(key, 64 * (d - 1)::INT) AS key, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
under AS (
  SELECT left(b.key, 64 * p::INT) AS key, sum((n - 1) * w) AS saved, count(*) FILTER (kids IS NULL) AS leaves
  FROM (SELECT node.*, kids, unnest(range(d + 1)) AS p FROM node LEFT JOIN child USING (key)) b GROUP BY 1
)
SELECT a.c AS conv_id, a.d AS depth, up.c AS parent_conv_id, a.n AS n_convs, coalesce(kids, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, a.ends AS ends_sha256
FROM node a LEFT JOIN child USING (key) JOIN under USING (key) LEFT JOIN node up ON a.d > 0 AND up.key = left(a.key, 64 * (a.d - 1)::INT)
"""


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (
        op1_sharding, op2_line_dedup, op3_simhash_near_dedup, op4_license_scans, op5_quality_rules, op6_benchmark_decontamination, op7_mixing,
        op8_chat_formatting, op9_toxicity, op10_language_id, op11_lm_scoring, op12_merkle_manifest, op13_prefix_trie,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op6_benchmark_decontamination": OP6_SQL, "op8_chat_formatting": OP8_SQL, "op12_merkle_manifest": OP12_SQL, "op13_prefix_trie": OP13_SQL}
