"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over SPAN successive tokens that ignores some positions, so a substituted token leaves
some mask's hash intact. Hashes of benchmark items and of documents meet in a join; a bitmap of all benchmark
hashes, of fixed size, keeps document hashes that cannot meet from being shuffled. Around each hit the tokens
are compared along the diagonal, and the best run is scored: an equal token counts 1, another one costs
PENALTY. A document is contaminated by an item when such a run holds enough of it.

Items of fewer than SHORT tokens have seeds of their own: windows of successive tokens, as many as every run that
reaches the score must hold in a row, however its other tokens are edited. So no run over such an item is lost.

Tokens are runs of letters and digits, lower-cased, so punctuation and case don't matter.

Defined cases: null, empty and tokenless texts match nothing; items of fewer than LEAST_SHORT tokens match where all
of their tokens stand in a row; a document that holds several items gives a row for
each; rows that repeat a doc_id or an item_id count once, as do those without one; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.scratch import Scratch
from lakespan.llm.skew import minus, row_key
from lakespan.llm.words import _MIX, U, finish, word_hashes

#: Positions that count.
MASKS = ("11111111", "110110110011", "101011001101001", "1110010100110101")
SPAN = max(map(len, MASKS))
#: Most tokens of an item that a diagonal is scored over; longer items are cut into overlapping parts.
PART, OVERLAP = 512, 64
PENALTY = 2.0
#: A run counts from that score, or from SHARE of a shorter item's tokens, but LEAST_SHORT or all of them at least.
LEAST_SCORE, SHARE, LEAST_SHORT = 13.0, 0.6, 6
#: Items of fewer tokens need less than LEAST_SCORE.
SHORT = 22
BITMAP_BITS = 24
_WORD = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> np.ndarray:
    return word_hashes(" ".join(_WORD.findall((text or "").lower())).encode())


def seeds(t: np.ndarray):
    """(mask number, hash of each window) for masks that fit."""
    for m, mask in enumerate(MASKS):
        n = len(t) - len(mask) + 1
        if n > 0:
            h = np.full(n, (m + 1) * 0x9E3779B97F4A7C15 % 2**64, U)
            for k, c in enumerate(mask):
                if c == "1":
                    h += t[k : k + n] * _MIX[k]
            yield m, finish(h)


def runs(equal: np.ndarray) -> tuple[float, int, int]:
    """Score, start and end of the best-scoring run."""
    total = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -PENALTY))])
    low = np.minimum.accumulate(total)
    end = int((total - low).argmax())
    return float(total[end] - low[end]), int(total[: end + 1].argmin()), end


def wanted(n: int) -> float:
    """The score that a run over an item of n tokens must reach."""
    return min(LEAST_SCORE, max(min(n, LEAST_SHORT), SHARE * n))


def in_a_row(n: int) -> int:
    """So many equal tokens in a row are in every run over an item of n tokens that reaches wanted(n): e equal tokens
    and m others score e - PENALTY * m, with e + m <= n, and the others part them into m + 1 rows at most."""
    score = math.ceil(wanted(n))
    rows = [(m, math.ceil(score + PENALTY * m)) for m in range(n)]
    return min(-(-e // (m + 1)) for m, e in rows if e + m <= n)


def short_kind(n: int) -> int:
    """The seeds of an item of n tokens, n < SHORT: their length, below zero where it is all of the item's tokens."""
    return -n if n < LEAST_SHORT else in_a_row(n)


def item_parts(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, part, n, tokens, seeds): tokens and seeds are arrays; n counts the item's tokens."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = tokens(t)
                if not len(h):
                    continue
                for part, a in enumerate(range(0, max(1, len(h) - OVERLAP), PART - OVERLAP)):
                    own = h[a : a + PART]
                    kinds = [short_hash(own, short_kind(len(h)))] if len(h) < SHORT else [hs for _, hs in seeds(own)]
                    got = [{"h": int(x), "p": p} for hs in kinds for p, x in enumerate(hs.view(np.int64))]
                    rows.append((i, part, len(h), own.view(np.int64), got))
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["item_id", "part", "n", "tokens", "seeds"])

    return items.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text")).dropDuplicates().mapInArrow(run, "item_id long, part int, n int, tokens array<long>, seeds array<struct<h:long,p:int>>")


def short_hash(t: np.ndarray, kind: int) -> np.ndarray:
    """A hash of each window of that many tokens, for short items of that kind."""
    size = abs(kind)
    h = np.full(max(len(t) - size + 1, 0), (0xD6E8FEB86659FD93 + kind * 0x9E3779B97F4A7C15) % 2**64, U)
    for k in range(size):
        h += t[k : k + len(h)] * _MIX[k]
    return finish(h)


def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in the bitmap."""
    return h >> U(64 - BITMAP_BITS), (h >> U(8)) & U((1 << BITMAP_BITS) - 1)


def known(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes may be those of a benchmark; bits holds 8 bits in each byte."""
    one, two = places(h)
    at = np.flatnonzero((bits[one >> U(3)] << (one & U(7)).astype(np.uint8)) & 128)
    two = two[at]
    return at[((bits[two >> U(3)] << (two & U(7)).astype(np.uint8)) & 128) > 0]


def bitmap(parts: DataFrame) -> bytes:
    """2**BITMAP_BITS bits, two for each benchmark hash: of that size however many items there are."""

    def run(batches):
        bits = np.zeros(1 << BITMAP_BITS, bool)
        for b in batches:
            for at in places(b.column(0).to_numpy(zero_copy_only=False).view(U)):
                bits[at] = True
        at = np.flatnonzero(np.packbits(bits))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.packbits(bits)[at].astype(np.int32))], ["at", "bits"])

    hashes = parts.select(F.explode("seeds.h").alias("h"))
    rows = hashes.mapInArrow(run, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.tobytes()


def regions(docs: DataFrame, bits, reach: int, short: list[int]) -> DataFrame:
    """(doc_id, region, tokens, hits) around hashes of docs (doc_id, text) that the bitmap knows.

    short has the kinds of the short items. A region is a stretch of tokens that holds the hits and reach tokens to
    either side; hits are (hash, position in the region)."""

    def run(batches):
        own = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = tokens(text.as_py())
                at, hs = [], []
                for kind, h in [*((0, h) for _, h in seeds(t)), *((k, short_hash(t, k)) for k in short)]:
                    hit = known(h, own)
                    if kind < 0:  # all of an item's tokens: its first place is its best run, others are no better
                        hit = np.sort(hit[np.unique(h[hit], return_index=True)[1]])
                    at.append(hit)
                    hs.append(h[hit])
                if not sum(map(len, at)):
                    continue
                at, hs = np.concatenate(at), np.concatenate(hs).view(np.int64)
                order = np.argsort(at, kind="stable")
                at, hs = at[order], hs[order]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(at) > 2 * reach) + 1, [len(at)]])
                for r, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    a = max(0, int(at[x]) - reach)
                    rows.append((doc, int(a), t[a : int(at[y - 1]) + reach + SPAN].view(np.int64), [{"h": int(h), "p": int(p) - a} for h, p in zip(hs[x:y], at[x:y], strict=True)]))
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "region", "tokens", "hits"])

    return docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").mapInArrow(run, "doc_id long, region long, tokens array<long>, hits array<struct<h:long,p:int>>")


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_token, n_tokens, equal): each item a document holds, with the best run."""
    spark = docs.sparkSession
    s = Scratch(spark, "decontam")
    # Numbers that are written with parts and regions stand for them, so rows without an id take part as well.
    parts = s.cut(item_parts(items).withColumn("part_id", F.monotonically_increasing_id()), "parts")
    reach = int(parts.agg(F.max(F.size("tokens")).alias("reach")).first()["reach"] or 0)
    # Fewer than SHORT numbers reach the driver.
    short = sorted({short_kind(r["n"]) for r in parts.where(F.col("n") < SHORT).select("n").distinct().collect()})
    bits = spark.sparkContext.broadcast(bitmap(parts))
    found = s.cut(regions(docs, bits, reach, short).withColumn("region_id", F.monotonically_increasing_id()), "regions")
    hits = found.select("region_id", F.inline("hits")).withColumnRenamed("p", "at")
    keys = parts.select("part_id", F.inline("seeds"))
    diagonals = hits.join(keys, "h").select("region_id", "part_id", (F.col("at") - F.col("p")).alias("diagonal")).distinct()
    known = parts.select("part_id", "item_id", "n", F.col("tokens").alias("item"))
    both = diagonals.join(known, "part_id").join(found.select("region_id", "doc_id", "region", "tokens"), "region_id")

    def verify(batches):
        for b in batches:
            rows = []
            for doc, region, item, d, n, x, y in zip(*(b.column(c).to_pylist() if c not in ("item", "tokens") else b.column(c) for c in ("doc_id", "region", "item_id", "diagonal", "n", "item", "tokens")), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                a, e = max(0, -d), min(len(x), len(y) - d)
                if e <= a:
                    continue
                equal = x[a:e] == y[a + d : e + d]
                score, first, last = runs(equal)
                if score >= wanted(n):
                    rows.append((doc, item, score, region + a + d + first, last - first, int(equal[first:last].sum())))
            cols = zip(*rows, strict=True) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "score", "first_token", "n_tokens", "equal"])

    scored = both.select("doc_id", "region", "item_id", "diagonal", "n", "item", "tokens").mapInArrow(verify, "doc_id long, item_id long, score double, first_token long, n_tokens long, equal long")
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "equal", -F.col("first_token"), "n_tokens")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.col3")).alias("first_token"), F.col("b.n_tokens").alias("n_tokens"), F.col("b.equal").alias("equal"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs that hold no benchmark item; each row is judged by its own text, whatever its doc_id. docs is read twice,
    not copied, so it must give the same rows each time, as a table does."""
    s = Scratch(docs.sparkSession, "clean")
    rows = docs.withColumn("__uid", row_key())
    gone = overlaps(rows.select(F.col("__uid").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("__uid")).distinct()
    return minus(rows, "__uid", s.cut(gone, "gone")).drop("__uid")
