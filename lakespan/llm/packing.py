"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become token ids with a closing id; only those longer than a sequence are cut, into full pieces with
the shorter one first. Full pieces are sequences by themselves. All other pieces are dealt into blocks of a
bounded number of pieces. For each block, islands evolve their own populations of packings: crossover injects
whole well-filled bins of one parent into the other, removes bins that hold the same pieces and the emptiest bins of the
other parent, lets displaced pieces take the place of shorter ones in bins with room, and best-fits the rest, the
longest first. Between epochs elites migrate to the next island through a shuffle. The best packing of each block is
taken. A block whose packing meets a lower bound is done, so only hard blocks take the time. Only lengths take part in
this; a block's state is bounded by BLOCK.

Defined cases: a null text is empty, so its only id is the closing one; rows that repeat a document are packed
each; ties of packings go to the lower island; an empty table gives no pieces; other columns are left out. Whole texts
are tokenised.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.scratch import Scratch

SEQUENCE = 2048
#: Expected pieces of a block.
BLOCK = 6_000
ISLANDS, POPULATION, EPOCHS, CHILDREN = 2, 4, 3, 100
#: An island's epoch ends after so many children in a row that are no better than their elite.
PATIENCE = 25
#: Share of the better half of a parent's bins that is injected, share of bins that are emptied, and bins that are refined.
INJECTED, EMPTIED, REFINED = 1 / 8, 0.05, 800
#: Ranks of the vocabulary, and the file that also names its added tokens.
VOCABULARY, ADDED = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def encoder(vocabulary: str | None = None):
    """text -> uint32 ids, those of byte_bpe_50k.json (a test compares them): the ranks hold its vocabulary, and its
    added tokens are taken as one id wherever a text holds them. This reader takes about a quarter of the time."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    with open(public_tokenizers.path(ADDED), encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> np.ndarray:
        try:
            return np.asarray(e.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        except ValueError:  # its pattern gives up on very long runs of blanks
            if vocabulary:
                raise
            from tokenizers import Tokenizer

            return np.array(Tokenizer.from_file(str(public_tokenizers.path(ADDED))).encode(text, add_special_tokens=False).ids, "<u4")

    return encode


def cut(n: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, after a shorter first one where n asks for it."""
    first = n % most or most
    return [(0, min(first, n)), *((a, most) for a in range(first, n, most))]


def pieces(docs: DataFrame, most: int = SEQUENCE, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs (doc_id, text)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        encode = encoder(vocabulary)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
                rows += [(doc, i, a, n, zlib.crc32(ids[a : a + n])) for i, (a, n) in enumerate(cut(len(ids), most))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], items, gaps: list[int], where: np.ndarray, most: int) -> None:
    """Put items, in their order, where least room is left over; opens bins as needed. Changes gaps and where."""
    by: dict[int, list[int]] = {}
    mask = 0
    for b, g in enumerate(gaps):
        if g:
            by.setdefault(g, []).append(b)
            mask |= 1 << g
    for i in items:
        s = sizes[i]
        fits = mask >> s
        if fits:
            g = s + (fits & -fits).bit_length() - 1
            stack = by[g]
            b = stack.pop()
            if not stack:
                mask ^= 1 << g
        else:
            g, b = most, len(gaps)
            gaps.append(most)
        where[i] = b
        g -= s
        gaps[b] = g
        if g:
            by.setdefault(g, []).append(b)
            mask |= 1 << g


def fitness(sizes: np.ndarray, where: np.ndarray, most: int) -> float:
    """Fewer bins first, then fuller ones: the mean square of how full bins are, less one for each bin."""
    fill = np.bincount(where, sizes) / most
    fill = fill[fill > 0]
    return float((fill * fill).mean() - len(fill)) if len(fill) else 0.0


def seed_packing(sizes: np.ndarray, most: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Best-fit over pieces from long to short, lengths blurred by noise."""
    order = np.argsort(-(sizes * (1 + noise * rng.standard_normal(len(sizes)))), kind="stable")
    where, gaps = np.empty(len(sizes), np.int32), []
    best_fit(sizes.tolist(), order.tolist(), gaps, where, most)
    return where


def refine(sizes: list[int], where: np.ndarray, gaps: list[int], loose: list[int], rng: np.random.Generator, tries: int = REFINED) -> list[int]:
    """Give bins with room the longest loose item that fits in place of a shorter one; what is loose then, from long to
    short. Changes where and gaps."""
    pool = sorted((sizes[i], i) for i in loose)
    order = np.argsort(where, kind="stable")
    starts = np.searchsorted(where[order], np.arange(len(gaps) + 1))
    room = np.flatnonzero(gaps)
    for b in rng.permutation(room)[:tries].tolist():
        for out in order[starts[b] : starts[b + 1]].tolist():
            at = bisect_right(pool, (sizes[out] + gaps[b], len(sizes))) - 1
            if at >= 0 and pool[at][0] > sizes[out]:
                size, i = pool.pop(at)
                where[i], where[out] = b, -1
                gaps[b] -= size - sizes[out]
                insort(pool, (sizes[out], out))
                break
    return [i for _, i in reversed(pool)]


def crossover(sizes: np.ndarray, one: np.ndarray, two: np.ndarray, most: int, rng: np.random.Generator) -> np.ndarray:
    """A child: bins of two that are well filled go whole into one."""
    fill = np.bincount(two, sizes)
    well = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
    take = np.zeros(len(fill), bool)
    take[rng.choice(well, max(1, int(len(well) * INJECTED)), replace=False)] = True
    injected = take[two]
    hit = np.zeros(one.max() + 1, bool)
    hit[one[injected]] = True  # these bins hold a piece that comes in with another bin
    hit[np.argsort(np.bincount(one, sizes), kind="stable")[: max(2, int(len(hit) * EMPTIED))]] = True
    displaced = hit[one] & ~injected
    kept = ~injected & ~displaced
    child = np.full(len(sizes), -1, np.int64)
    _, child[kept] = np.unique(one[kept], return_inverse=True)
    first = int(child.max()) + 1
    _, new = np.unique(two[injected], return_inverse=True)
    child[injected] = first + new
    placed = child >= 0
    gaps = (most - np.bincount(child[placed], sizes[placed]).astype(np.int64)).tolist()
    plain = sizes.tolist()
    loose = refine(plain, child, gaps, np.flatnonzero(displaced).tolist(), rng)
    best_fit(plain, loose, gaps, child, most)
    return child.astype(np.int32)


def least_bins(sizes: np.ndarray, most: int) -> int:
    """No packing has fewer bins: all lengths together, or pieces over half a bin with what can't go beside them."""
    bound = -(-int(sizes.sum()) // most)
    large = np.sort(sizes[2 * sizes > most])
    for k in np.unique(sizes[2 * sizes <= most])[:: max(1, len(sizes) // 64)]:
        alone = len(large) - np.searchsorted(large, most - k, "right")  # too long for a piece of k or more
        beside = large[large <= most - k]
        small = int(sizes[(sizes >= k) & (2 * sizes <= most)].sum())
        bound = max(bound, alone + len(beside) + max(0, -(-(small - int((most - beside).sum())) // most)))
    return max(bound, len(large))


def evolve(sizes: np.ndarray, population: list[np.ndarray], most: int, rng: np.random.Generator, keep: int = POPULATION, children: int = CHILDREN) -> list[np.ndarray]:
    """The best of a population and its children; sizes go from long to short."""
    score = lambda w: -fitness(sizes, w, most)
    ranked, stale = sorted(((score(w), i, w) for i, w in enumerate(population)), key=lambda x: x[:2]), 0
    bound = least_bins(sizes, most)
    for n in range(children):
        if len(ranked) < 2 or stale >= PATIENCE or int(ranked[0][2].max()) + 1 <= bound:
            break
        i, j = rng.choice(len(ranked), 2, replace=False)
        child = crossover(sizes, ranked[i][2], ranked[j][2], most, rng)
        was = ranked[0][0]
        ranked = sorted([*ranked, (score(child), len(population) + n, child)], key=lambda x: x[:2])[:keep]
        stale = 0 if ranked[0][0] < was else stale + 1
    return [w for _, _, w in ranked[:keep]]


_CHROMOSOMES = "block long, island int, rank int, fitness double, sizes binary, bins binary"


def _rows(block: int, island: int, sizes: np.ndarray, ranked: list[np.ndarray], most: int) -> pd.DataFrame:
    return pd.DataFrame([(block, island, i, fitness(sizes, w, most), sizes.astype(np.int32).tobytes(), w.astype(np.int32).tobytes()) for i, w in enumerate(ranked)], columns=["block", "island", "rank", "fitness", "sizes", "bins"])


def pack(cuts: DataFrame, most: int = SEQUENCE, block: int = BLOCK) -> DataFrame:
    """cuts (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    spark = cuts.sparkSession
    s = Scratch(spark, "packing")
    # The number of a row is written with it, so that every later reading deals it to the same block.
    cuts = s.cut(cuts.withColumn("uid", F.monotonically_increasing_id()), "cuts")
    full = cuts.where(F.col("length") >= most)
    short = cuts.where(F.col("length") < most)
    n_blocks = -(-short.count() // block) or 1
    dealt = short.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)))

    def begin(key, pdf):
        sizes = np.sort(pdf["length"].to_numpy())[::-1]
        rng = np.random.default_rng([int(key[0]), int(key[1])])
        first = [seed_packing(sizes, most, rng, 0.0 if i == 0 else 0.02 * i * (1 + int(key[1]))) for i in range(POPULATION)]
        return _rows(int(key[0]), int(key[1]), sizes, evolve(sizes, first, most, rng), most)

    def again(key, pdf):
        sizes = np.frombuffer(pdf["sizes"].iloc[0], np.int32).astype(np.int64)
        pdf = pdf.sort_values(["fitness", "rank"], ascending=[False, True])
        rng = np.random.default_rng([int(key[0]), int(key[1]), len(pdf)])
        return _rows(int(key[0]), int(key[1]), sizes, evolve(sizes, [np.frombuffer(b, np.int32) for b in pdf["bins"]], most, rng), most)

    islands = dealt.select("block", "length").withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    found = s.cut(islands.groupBy("block", "island").applyInPandas(begin, _CHROMOSOMES), "epoch-0")
    for e in range(1, EPOCHS):
        elites = found.where("rank = 0").withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))
        found = s.cut(found.unionByName(elites.withColumn("rank", F.lit(99))).groupBy("block", "island").applyInPandas(again, _CHROMOSOMES), f"epoch-{e}")
    best = found.groupBy("block").agg(F.max(F.struct("fitness", -F.col("island"), "bins"))["bins"].alias("bins"))

    def place(key, left, right):
        left = left.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where = np.frombuffer(right["bins"].iloc[0], np.int32)
        order = np.argsort(where, kind="stable")
        left, where = left.iloc[order], where[order]
        fill = left["length"].to_numpy()
        before = np.cumsum(fill) - fill
        starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        dense = np.cumsum(np.r_[True, where[1:] != where[:-1]]) - 1
        return left.assign(sequence_id=(2 * (int(key[0]) * (1 << 30) + dense)).astype(np.int64), offset=before - before[starts][dense])

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = dealt.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(lambda k, a, b: place(k, a, b)[[c.split()[0] for c in columns.split(", ")]], columns)
    own = full.withColumn("sequence_id", 2 * F.col("uid") + 1).withColumn("offset", F.lit(0).cast("long"))
    return s.last(packed.unionByName(own.drop("uid")))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
