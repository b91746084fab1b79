"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly if a third value lies within r bits of both. So every fingerprint
emits all values in its ball of radius r, equal values meet, and what meets is verified and linked.

A ball is sent in factored form: the flips within the leading bits are made before the shuffle, which brings each
leading part with its fingerprints and the number of flips left to one task; the flips in the remaining bits are made
there, in slices of bounded size. So a fingerprint of 64 bits with r = 2 and 10 leading bits is sent 56 times, not 2,081.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.llm.common import components, stored

BITS = 64
#: Bytes of a text that are split into words at once, shingles whose bits are counted at once, ball values sorted at once.
BLOCK, SHINGLES, VALUES = 1 << 22, 1 << 16, 1 << 21


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text in blocks, cut at blanks."""
    at = 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end].split()
        at = end


def _hashes(data: bytes, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k-word shingle in blocks; of the whole sequence if it has fewer words."""
    rest: list[bytes] = []
    seen = False
    for block in _words(data):
        words = rest + block
        for at in range(0, len(words) - k + 1, SHINGLES):
            part = words[at : at + SHINGLES + k - 1]
            ends = np.cumsum([len(w) + 1 for w in part]) - 1
            starts = [0, *(ends[: len(part) - k] + 1).tolist()]
            joined = b" ".join(part)
            seen = True
            yield np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64)
        rest = words[max(0, len(words) - k + 1) :]
    if rest and not seen:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(rest), 42)], np.uint64)


def fingerprint(text: str | None, k: int = 4) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; no word: 0."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for h in _hashes((text or "").encode().lower(), k):
        total += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()) if total else 0


def fingerprint_column(text: Column, k: int = 4) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, k) for t in batch], np.uint64).view(np.int64))

    return run(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _flips(first: int, last: int, most: int) -> list[tuple[int, int]]:
    """Masks of up to ``most`` of the bits first to last - 1, counted from the top, with the number of their bits."""
    at = [1 << (BITS - 1 - i) for i in range(first, last)]
    return [(_signed(sum(c)), n) for n in range(most + 1) for c in combinations(at, n)]


def _send(df: DataFrame, first: int, last: int, most: int) -> DataFrame:
    """All flips that the rows (value, fp, spare) have left within some bits; range: the bits fixed so far."""
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("m"), F.lit(n).alias("n")) for m, n in _flips(first, last, most)))
    rows = df.withColumn("f", F.explode(masks)).where("f.n <= spare")
    value = F.col("value").bitwiseXOR(F.col("f.m"))
    return rows.select(
        F.lit(last).alias("fixed"), F.shiftrightunsigned(value, BITS - last).alias("range"), value.alias("value"), "fp", (F.col("spare") - F.col("f.n")).alias("spare")
    )


def _meet(value: np.ndarray, spare: np.ndarray, owner: np.ndarray, fixed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owners with an equal ball value, as neighbours of each run; halves the range until its values fit into one slice."""
    if len(value) < 2:
        return
    free = BITS - fixed
    per = np.array([1 + free * (s > 0) + free * (free - 1) // 2 * (s > 1) for s in range(3)])
    if fixed < BITS and per[spare].sum() > VALUES:
        bit = np.uint64(1 << (free - 1))
        one = (value & bit) > 0
        for side in (False, True):
            stay, flip = one == side, (one != side) & (spare > 0)
            yield from _meet(
                np.concatenate([value[stay], value[flip] ^ bit]), np.concatenate([spare[stay], spare[flip] - 1]), np.concatenate([owner[stay], owner[flip]]), fixed + 1
            )
        return
    one = np.uint64(1) << np.arange(free, dtype=np.uint64)
    left, right = np.triu_indices(free, 1)
    parts, owners = [value], [owner]
    for masks, least in ((one, 1), (one[left] | one[right], 2)):
        more = spare >= least
        parts.append((value[more][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(owner[more], len(masks)))
    values, owners = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(values)
    values, owners = values[order], owners[order]
    same = np.flatnonzero(values[1:] == values[:-1])
    yield owners[same], owners[same + 1]


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the links a-b; each root is the smallest of its set."""
    while (apart := parent[a] != parent[b]).any():
        a, b = a[apart], b[apart]
        x, y = parent[a], parent[b]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
    return parent


def _links(frame: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning links of one range: as many as it has fingerprints at most, however many pairs meet."""
    fps, owner = np.unique(frame["fp"].to_numpy().view(np.uint64), return_inverse=True)
    parent = np.arange(len(fps))
    for a, b in _meet(frame["value"].to_numpy().view(np.uint64), frame["spare"].to_numpy(), owner, int(frame["fixed"].iloc[0])):
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        parent = _joined(parent, a[near], b[near])
    tied = np.flatnonzero(parent != np.arange(len(fps)))
    return pd.DataFrame({"a": fps[tied].view(np.int64), "b": fps[parent[tied]].view(np.int64)})


def near_fingerprints(fps: DataFrame, max_bits: int = 4, lead_bits: int = 10, per_range: int = 500_000) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column fp that connect all within ``max_bits`` of each other.

    A range with over ``per_range`` rows is dealt out anew by its next bits, so a dense crowd of fingerprints spreads
    over many tasks; no pair is lost, since every remaining flip in those bits is sent too.
    """
    radius = -(-max_bits // 2)
    if not 0 <= radius <= 2:
        raise ValueError("balls of radius 0 to 2 are supported: at most 4 differing bits")
    todo = fps.select(F.col("fp").alias("value"), "fp", F.lit(radius).alias("spare"))
    done, fixed = [], 0
    while fixed < BITS:
        last = min(BITS, fixed + lead_bits)
        rows = _send(todo, fixed, last, radius)
        crowded = stored(rows.groupBy("range").count().where(F.col("count") > per_range).select("range"))
        if last == BITS or crowded.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(crowded, "range", "left_anti").select(rows.columns))
        todo, fixed = rows.join(crowded, "range", "left_semi"), last
    links = [rows.groupBy("range").applyInPandas(lambda frame: _links(frame, max_bits), "a long, b long") for rows in done]
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 4, max_bits: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, the columns in ``keep``, fingerprint (16 hex digits), group (one of the group's
    fingerprints as a long) and component_id.

    Texts are lower-cased A-Z and cut at ASCII blanks into k-word shingles. Null, empty and blank texts have fingerprint 0
    and are linked like any other; fewer than k words make one shingle. component_id is the smallest id that chains of
    links of at most ``max_bits`` differing bits reach; null ids get one, but never are one. Repeated rows stay. An empty
    table gives an empty result. Columns that aren't asked for are not read, so their names can't clash.
    """
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), *keep, fingerprint_column(F.col(text), k).alias("fp")))
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(near_fingerprints(fps, max_bits)).withColumnRenamed("node", "fp")
    placed = fps.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = placed.join(lows, "root").select("fp", F.col("root").alias("group"), "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(ids, "fp").select("doc_id", *keep, hexed, "group", "component_id")
