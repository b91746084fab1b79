"""Language-model scores of whole documents: a gated recurrent network over frequent words, corpus counts for all others.

Every token of the corpus is counted. Frequent words (whole ranks of counts, ``KNOWN`` words at most) are known to every
task; the first ``WORDS`` of them are the network's own. A document's tokens are looked up and scored where it is read, its
state carried from window to window until its end; tokens that are not known there are joined to their counts, which are
small, so no key is hot. A word outside the network's is told by the chance of its class and then by its share of the counts.

The network learns from all training documents, each in one of ``ROUNDS`` rounds: trainers, each on its own documents, start
from the same weights, and their results are averaged after each round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from quartzo.llm import gru
from quartzo.llm.common import unused
from quartzo.session import cut_lineage

#: Words that every task knows at most, words of the network, parts of ranks to a doubling of counts.
KNOWN, WORDS, RANKS = 131_072, 4_096, 16
#: One training document in so many teaches the network; rounds; tokens for each trainer while they last.
SHARE, ROUNDS, TAUGHT = 1, 2, 250_000
#: Tokens that a task counts before it passes them on; bytes of texts that are cut into tokens at once; weights in a row.
COUNTED, PIECE, CHUNK = 2_000_000, 1 << 22, 4096
END = b""


@dataclass
class Model:
    """counts: of the tokens beyond the known ones (token, n). known: tokens by rank, END first; n: their counts. total and
    distinct: of all training tokens."""

    counts: DataFrame
    known: list[bytes]
    n: np.ndarray
    total: int
    distinct: int
    words: int
    weights: gru.Weights

    @property
    def rest(self) -> float:
        """What the counts of all words outside the network add up to, smoothed."""
        return self.total - int(self.n[: self.words].sum()) + 0.1 * (self.distinct - self.words + 1)


def pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """Tokens of a text without its end, A-Z lower-cased, a bounded number of bytes at a time; no token is cut."""
    text, at = text or b"", 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[at:end].lower().split()  # of bytes: between blanks of ASCII, A-Z only
        at = end


def _tokens(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Tokens of all texts in their order, each text's end (empty) after its last, and their rows; a bounded number of bytes at a time."""
    texts = batch.column(name).cast(pa.large_string()).fill_null("")
    size, at = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), 0
    before = np.append(0, np.cumsum(size))
    while at < len(texts):
        if size[at] > PIECE:
            for tokens in _ended(texts[at].as_buffer().to_pybytes()):
                yield np.full(len(tokens), at), pa.array(tokens, pa.large_binary())
            at += 1
            continue
        end = int(np.searchsorted(before, before[at] + PIECE, side="right")) - 1
        part = pc.ascii_trim_whitespace(texts.slice(at, end - at))
        # what stands behind the last blank is the end
        cut = pc.if_else(pc.equal(pc.binary_length(part), 0), part, pc.binary_join_element_wise(part, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(cut))
        yield at + pc.list_parent_indices(lists).to_numpy(), lists.flatten().cast(pa.large_binary())
        at = end


def count_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """token (END is empty) and n, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def shown() -> pa.RecordBatch:
            found = pc.value_counts(pa.concat_arrays(held))
            held.clear()
            return pa.RecordBatch.from_arrays([found.field(0).cast(pa.binary()), found.field(1)], ["token", "n"])

        for batch in batches:
            for _, tokens in _tokens(batch, "text"):
                held.append(tokens)
                n += len(tokens)
                if n > COUNTED:
                    yield shown()
                    n = 0
        if held:
            yield shown()

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "token binary, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def _ranks(tokens: pa.Array, known: pa.Array, other: int) -> np.ndarray:
    return pc.index_in(tokens, value_set=known).fill_null(other).to_numpy(zero_copy_only=False).astype(np.int32)


def _ended(text: bytes | None) -> Iterator[list[bytes]]:
    last: list[bytes] = []
    for tokens in pieces(text):
        if last:
            yield last
        last = tokens
    yield [*last, END]


def _taught(docs: DataFrame, model: Model, by: Column, trainers: int) -> gru.Weights:
    """Weights after one round: the mean of what the trainers learned, weighted by their tokens."""
    known, words, start = model.known[: model.words], model.words, model.weights
    c = gru.classes(model.n[:words])
    shapes = {n: v.shape for n, v in start.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.array(known, pa.large_binary())

        def ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            parts, row = [], 0
            for rows, tokens in _tokens(batch, "text"):
                cuts = np.flatnonzero(np.diff(rows)) + 1
                for part, of in zip(np.split(_ranks(tokens, own, words), cuts), rows[np.append(0, cuts)]):
                    if of != row:
                        yield np.concatenate(parts)
                        parts, row = [], of
                    parts.append(part)
            if parts:
                yield np.concatenate(parts)

        texts = (t for b in batches for t in ids(b))
        learned, seen = gru.fit(start, c, texts)
        if seen:
            flat = np.concatenate([learned[n].ravel() for n in shapes])
            parts = [flat[a : a + CHUNK].tobytes() for a in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["part", "seen", "data"])

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["seen", "data"])  # in one order, whatever came first
        parts = np.stack([np.frombuffer(x, np.float32) for x in rows["data"]]).astype(np.float64)
        out = (parts * (rows["seen"].to_numpy() / rows["seen"].sum())[:, None]).sum(0).astype(np.float32)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "data": [out.tobytes()]})

    dealt = docs.select("text", by.alias("by")).repartition(trainers, "by").sortWithinPartitions("by", "text").select("text")
    learned = dealt.mapInArrow(run, "part int, seen long, data binary").groupBy("part").applyInPandas(mean, "part int, data binary")
    rows = sorted(learned.collect())  # the weights of one network
    if not rows:
        return start
    flat, out, at = np.frombuffer(b"".join(bytes(r.data) for r in rows), np.float32), {}, 0
    for n, shape in shapes.items():
        out[n] = flat[at : at + math.prod(shape)].reshape(shape).copy()
        at += math.prod(shape)
    return out


def fit(docs: DataFrame, by: Column, text: str = "text") -> Model:
    """Counts of all of ``docs``, and a network taught by all of them; a hash of ``by`` draws the round."""
    counted = cut_lineage(count_tokens(docs, text))
    rank = F.floor(F.log2("n") * RANKS)
    # one row for each rank: 16 to a doubling
    ranks = counted.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).orderBy(F.desc("rank")).collect()
    total, distinct = sum(r.n for r in ranks), sum(r.words for r in ranks)
    least, held = math.inf, 0
    for r in ranks:
        held += r.words
        if held > KNOWN:
            break
        least = r["rank"]
    is_known = (rank >= (least if ranks and least < math.inf else 1 << 30)) | (F.col("token") == END)
    known = sorted(((bytes(r.token), r.n) for r in counted.where(is_known).collect()), key=lambda x: (x[0] != END, -x[1], x[0]))
    n, words = np.array([x[1] for x in known], np.float64), min(WORDS, len(known))
    model = Model(counted.where(~is_known), [x[0] for x in known], n, total, distinct, words, gru.begin(n[:words], total - n[:words].sum()))
    draw = F.pmod(F.xxhash64(by, F.lit(11)), F.lit(SHARE * ROUNDS))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trainers = max(1, min(parts, round(total / (SHARE * ROUNDS * TAUGHT))))
    for k in range(ROUNDS):
        drawn = docs.where(draw == k).select(F.col(text).cast("string").alias("text"), F.xxhash64(by).alias("by"))
        model.weights = _taught(drawn, model, F.col("by"), trainers)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows, with the columns to ``keep`` (all), n_tokens, n_known (in the training tokens), train_tokens, base_score and
    score: log10 probabilities of the whole text and its end by the smoothed counts, and by the model.

    Null and empty texts, and such of blanks only, are one token, the end. Texts of any length are read whole, in pieces;
    memory grows by four bytes a token. Repeated rows get equal scores but for the last digits. Without training tokens every
    token's chance is one by the counts. An empty table gives an empty result. Columns of the same names are replaced.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    rid, given, told = unused(docs, "rid", "given", "told")
    known, words, weights = model.known, model.words, model.weights
    logs = np.append(np.log10(model.n + 0.1), 0.0)
    c = gru.classes(model.n[:words])
    kinds = [("n_tokens", LongType()), ("n_sure", LongType()), ("n_rest", LongType()), ("sure_log", DoubleType()), ("outside_log", DoubleType()), ("net_log", DoubleType())]
    kinds += [("rest", ArrayType(BinaryType())), ("times", ArrayType(LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure, scorer = pa.array(known, pa.large_binary()), gru.Scorer(weights, c)
        for batch in batches:
            if not batch.num_rows:
                continue
            many, ids, unknown, rest = batch.num_rows, [], [], []
            n, n_sure, n_far, sure_log, far_log = np.zeros((5, many))
            for rows, tokens in _tokens(batch, told):
                ranks = _ranks(tokens, sure, len(known))
                far, lost, of = ranks >= words, ranks == len(known), logs[ranks]  # those without a rank have a log of zero
                n += np.bincount(rows, minlength=many)
                n_sure += np.bincount(rows[~lost], minlength=many)
                n_far += np.bincount(rows[far], minlength=many)
                sure_log += np.bincount(rows, of, many)
                far_log += np.bincount(rows[far], of[far], many)
                ids.append(np.minimum(ranks, words))
                unknown.append(rows[lost])
                rest.append(tokens.filter(pa.array(lost)))
            net = scorer(np.split(np.concatenate(ids), np.cumsum(n[:-1]).astype(np.int64))) / math.log(10)
            # a row's unknown tokens, each with the times it is there
            rest = pa.concat_arrays(rest).dictionary_encode()
            kinds_of = max(1, len(rest.dictionary))
            pairs, times = np.unique(np.concatenate(unknown) * kinds_of + rest.indices.to_numpy(), return_counts=True)
            at = pa.array(np.searchsorted(pairs, np.arange(many + 1) * kinds_of), pa.int32())
            lists = [pa.ListArray.from_arrays(at, rest.dictionary.take(pa.array(pairs % kinds_of)).cast(pa.binary())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
            own = [pa.array(x.astype(np.int64)) for x in (n, n_sure, n_far)] + [pa.array(x, pa.float64()) for x in (sure_log, far_log, net)]
            names = [rid, given]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *own, *lists], names=[*names, *(k for k, _ in kinds)])

    rows = docs.select(F.monotonically_increasing_id().alias(rid), F.struct(*(F.col(f"`{x}`") for x in kept)).alias(given), F.col(f"`{text}`").cast("string").alias(told))
    schema = StructType([*(f for f in rows.schema.fields if f.name != told), *(StructField(n, k) for n, k in kinds)])
    rows = cut_lineage(rows.mapInArrow(run, schema))
    each = rows.select(rid, F.explode(F.arrays_zip("rest", "times")).alias("x")).select(rid, F.col("x.rest").alias("token"), F.col("x.times").alias("times"))
    each = each.join(model.counts, "token", "left")
    rest = each.groupBy(rid).agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("rest_log"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("rest_known"))
    out = rows.drop("rest", "times").join(rest, rid, "left")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    every, other = math.log10(model.total + 0.1 * (model.distinct + 1)), math.log10(model.rest)
    return out.select(
        *(F.col(f"{given}.`{x}`").alias(x) for x in kept), "n_tokens", (F.col("n_sure") + F.coalesce("rest_known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("sure_log") + rest_log - F.col("n_tokens") * every).alias("base_score"), (F.col("net_log") + F.col("outside_log") + rest_log - F.col("n_rest") * other).alias("score"),
    )
