"""Near-duplicates by min-max hashing.

Each set of word shingles keeps the minimum and the maximum under each permutation, so half as many hash
evaluations give the signature. Bands of it name buckets. Texts with equal sets form one class, and only
classes meet in buckets. First each class is compared with the
best known of those it meets; then, in buckets that aren't settled, leaders with the others, round after round: a round is
linear in the bucket, and a bucket is done when every pair of its classes has been compared, is already in
one component, or can't be similar: shingles that no other class of the open buckets holds, and bits of one
bitmap that the other lacks, bound what two classes can share, which settles most pairs of a group of heavily
edited copies within the join, without making or comparing them. So no group
emits all its pairs. Pairs whose signatures differ far beyond what chance allows are put aside unconfirmed, which
loses a pair of similarity 0.75 with a chance of about 3e-9, besides 2.4e-5 by banding; all others are confirmed
on full sets.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing; shorter texts
than a shingle are one shingle; a null doc_id stays on its own with a null component and is kept; rows that
repeat a doc_id are judged by their own texts; the least doc_id stands for its component, so ties don't arise but
between rows that repeat it; whole texts are read, whatever their length; other columns are left out (keep_one keeps
them all); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakespan.llm.graph import components
from lakespan.llm.scratch import Scratch
from lakespan.llm.skew import few, hot_from, join_hot, maybe_in, minus, row_key
from lakespan.llm.words import _MIX, U, finish, raw_texts, shingle_set

WORDS, PERCENT = 5, 75
PERMUTATIONS, ROWS = 56, 4
BANDS = 2 * PERMUTATIONS // ROWS
_A = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, (PERMUTATIONS, 1), dtype=U) * U(2) + U(1)
_BAND = finish(np.arange(1, BANDS + 1, dtype=U))
#: A pair of the wanted similarity has fewer equal bytes of its sketches with a chance of about 3e-9.
LEAST_EQUAL = int(2 * PERMUTATIONS * 0.5)
#: Leaders of a bucket in each round; the last number holds for all further rounds.
LEADERS = (2, 8, 32, 128)
#: Rows of a bucket that a task takes; fuller ones are dealt over several.
HOT = 1000
#: What has at most so many rows is sent to all tasks rather than shuffled (a few MB; leaders, which are wide, a tenth).
SENT = 100_000
#: 64-bit words of the bitmap that bounds what two sets can share.
BITMAP = 16


def signature(x: np.ndarray) -> np.ndarray:
    """Minimum under each permutation, then maximum under each."""
    low, high = np.full(PERMUTATIONS, 2**64 - 1, U), np.zeros(PERMUTATIONS, U)
    for at in range(0, len(x), 2048):
        y = _A * x[None, at : at + 2048]
        np.minimum(low, y.min(1), out=low)
        np.maximum(high, y.max(1), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray) -> np.ndarray:
    return finish((sig.reshape(BANDS, ROWS) * _MIX[:ROWS]).sum(1, dtype=U) + _BAND).view(np.int64)


def sketch(sig: np.ndarray) -> bytes:
    """A byte of each value, for a cheap estimate."""
    return (finish(sig) >> U(56)).astype(np.uint8).tobytes()


def class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n, cls, bands, sketch) of docs (doc_id, text); the last three are null for an empty set."""

    def run(batches):
        for b in batches:
            rows = []
            for raw in raw_texts(b.column(1)):
                x = shingle_set(raw or b"", words)
                if len(x):
                    s = signature(x)
                    rows.append((len(x), class_of(x), bands(s), sketch(s)))
                else:
                    rows.append((0, None, None, None))
            n, c, k, s = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(k, pa.list_(pa.int64())), pa.array(s, pa.binary())], ["doc_id", "n", "cls", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, cls long, bands array<long>, sketch binary")


def shingles_of(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(cls, x) of docs (cls, text), rows whose text isn't of that class left out."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingle_set(raw or b"", words) for raw in raw_texts(part.column(1))]
                own = [(c, x.tobytes()) for c, x in zip(part.column(0).to_pylist(), sets, strict=True) if len(x) and class_of(x) == c]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in own], pa.int64()), pa.array([x for _, x in own], pa.large_binary()).cast(pa.binary())], ["cls", "x"])

    return docs.mapInArrow(run, "cls long, x binary")


def plausible(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose set sizes and sketches leave the similarity possible."""
    own = classes.select("cls", "n", "sketch")
    both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    both = both.where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")).select("a", "b", "sa", "sb")

    def run(batches):
        for b in batches:
            sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
            yield b.filter(pa.array((sa == sb).sum(1) >= LEAST_EQUAL)).select([0, 1])

    return both.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose full sets are as similar."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    sets = maybe_in(sets, "cls", wanted, "maybe").where("maybe").drop("maybe")
    both = pairs.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b")

    def run(batches):
        for b in batches:
            keep = []
            for xa, xb in zip(b.column(2), b.column(3), strict=True):
                xa, xb = np.frombuffer(xa.as_buffer(), U), np.frombuffer(xb.as_buffer(), U)
                if len(xa) > len(xb):
                    xa, xb = xb, xa
                same = int((xb[np.minimum(np.searchsorted(xb, xa), len(xb) - 1)] == xa).sum())
                keep.append(100 * same >= percent * (len(xa) + len(xb) - same))
            yield b.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def own_shingles(sets: DataFrame) -> DataFrame:
    """(cls, own): how many shingles of each class no other class of sets holds; classes without are left out."""

    def run(batches):
        for b in batches:
            for at in range(b.num_rows):
                x = np.frombuffer(b.column(1)[at].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), b.column(0)[at].as_py(), np.int64)), pa.array(x)], ["cls", "h"])

    rows = sets.select("cls", "x").mapInArrow(run, "cls long, h long")
    return rows.groupBy("h").agg(F.count("*").alias("k"), F.min("cls").alias("cls")).where("k = 1").groupBy("cls").agg(F.count("*").alias("own"))


def bitmaps(sets: DataFrame) -> DataFrame:
    """(cls, bits) of sets (cls, x): a bit for each shingle, by its hash, in BITMAP words; the number of bits comes last."""

    def run(batches):
        for b in batches:
            bits = np.zeros((b.num_rows, BITMAP), U)
            for row, x in zip(bits, b.column(1), strict=True):
                at = np.frombuffer(x.as_buffer(), U) & U(64 * BITMAP - 1)
                np.bitwise_or.at(row, (at >> U(6)).astype(int), U(1) << (at & U(63)))
            bits = np.hstack([bits, np.bitwise_count(bits).sum(1, dtype=U)[:, None]])
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (BITMAP + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(bits.view(np.int64).ravel()))], ["cls", "bits"])

    return sets.select("cls", "x").mapInArrow(run, "cls long, bits array<long>")


def overlap_bound(n, bits: str, m, other: str):
    """At most so many shingles are in both sets of n and m shingles: bits both have, and shingles that share a bit."""
    both = reduce(lambda x, y: x + y, (F.bit_count(F.col(bits)[i].bitwiseAND(F.col(other)[i])) for i in range(BITMAP)))
    return both + F.least(n - F.col(bits)[BITMAP], m - F.col(other)[BITMAP])


def may_link(n, own, m, other, percent: int):
    """Whether sets of n and m shingles, own and other of them unshared at least, may be as similar."""
    same = F.least(n - own, m - other)
    return F.lit(100) * same >= F.lit(percent) * (n + m - same)


def sent(df: DataFrame, rows: int, most: int = SENT) -> DataFrame:
    """df to be broadcast, if it has so few rows that it may be."""
    return F.broadcast(df) if rows <= most else df


def salted(by_bucket: DataFrame) -> DataFrame:
    """by_bucket (bucket, salts, ...) once for each salt of its bucket, to meet members on bucket and salt."""
    return by_bucket.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def unsettled(members: DataFrame, labels: DataFrame, s: Scratch, name: str, n: int) -> tuple[DataFrame, int]:
    """members (bucket, salt, salts, cls, ...) with comp, of those buckets that still hold several components, and how
    many rows that are; there are n members at most."""
    named = labels.select(F.col("u").alias("cls"), F.col("v").alias("comp"))
    now = members.join(named, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    split = now.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("salts").alias("salts")).where("lo <> hi").select("bucket", "salts")
    out = s.cut(few(now.join(sent(salted(split), n), ["bucket", "salt"]), n), name)
    return out, out.count()


def first_of(rows: DataFrame, order: list, most: int, dealt: bool) -> DataFrame:
    """The first rows of each bucket; where buckets are dealt over salts, those of each salt, then of these."""
    for by in (("bucket", "salt"), ("bucket",))[not dealt :]:
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("r") <= most)
    return rows.drop("r")


MEMBER = ("bucket", "salt", "salts", "cls", "n", "own", "bits")


def cluster(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text)."""
    s = Scratch(docs.sparkSession, "minhash")
    sig = s.cut(signatures(docs, words), "sig")
    docs_n = sig.count()
    ids = s.cut(few(sig.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("min_id"), F.count("*").alias("copies")), docs_n), "ids")
    classes = s.cut(few(sig.where("cls is not null and doc_id is not null").select("cls", "n", "sketch", "bands").dropDuplicates(["cls"]), docs_n), "classes")
    rows = classes.select("cls", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    salts = F.ceil(F.col("m") / F.lit(HOT)).cast("int")
    members = rows.join(shared, "bucket").select("bucket", "cls", "m", salts.alias("salts"), F.pmod(F.xxhash64("cls"), salts).cast("int").alias("salt"))
    members = s.cut(few(members, BANDS * docs_n), "members")

    met = s.cut(few(members.select("cls").distinct().join(ids, "cls").select("cls", F.col("min_id").alias("id")), docs_n), "met")
    own_texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    # Texts that meet no other aren't shuffled, but for those that the filter can't tell from them.
    texts = maybe_in(own_texts, "id", met, "maybe").where("maybe").join(met, "id").select("cls", "text")
    sets = s.cut(few(shingles_of(texts, words), docs_n), "sets")

    # First round: each class meets one other, the best known of those it shares a bucket with. An original
    # lies in its copies' fullest buckets, so a group of copies becomes a star of as many pairs as it has classes.
    score = members.groupBy("cls").agg(F.sum("m").alias("score"))
    known = members.select("bucket", "cls").join(score, "cls").select("bucket", F.struct("score", "cls").alias("by"))
    hub = members.select("bucket", "cls").join(known.groupBy("bucket").agg(F.max("by").alias("by")), "bucket").groupBy("cls").agg(F.max("by").cls.alias("hub"))
    pairs = hub.where("cls <> hub").select(F.least("hub", "cls").alias("a"), F.greatest("hub", "cls").alias("b")).distinct()
    tried = s.cut(few(plausible(pairs, classes, percent), docs_n), "tried-0")
    labels = components(s.cut(few(confirmed(tried, sets, percent), docs_n), "edges-0").toDF("u", "v"), s, "cc-0", docs_n)  # (class, least class of its component)
    known = members.agg(F.count("*").alias("n"), F.max("salts").alias("salts")).first()
    dealt = (known["salts"] or 1) > 1
    left, n = unsettled(members.select("bucket", "salt", "salts", "cls"), labels, s, "open-1", known["n"])
    left = left.drop("comp")
    if n:
        there = left.select("cls").distinct()
        own = there.join(classes.select("cls", "n"), "cls").join(own_shingles(sets.join(there, "cls", "left_semi")), "cls", "left")
        own = own.select("cls", "n", F.coalesce("own", F.lit(0)).alias("own")).join(bitmaps(sets.join(there, "cls", "left_semi")), "cls")
        left = s.cut(few(left.join(s.cut(few(own, docs_n), "own"), "cls"), n), "measured")
    i = 0
    while n:
        i += 1
        # A class that can't be similar to any set as large as the bucket's smallest has no link to lose there.
        least = left.groupBy("bucket").agg(F.min("n").alias("least"), F.max("salts").alias("salts"))
        near = F.greatest("least", F.col("n") - F.col("own"))
        fit = F.lit(100) * (F.col("n") - F.col("own")) >= F.lit(percent) * (near + F.col("own"))
        # Written before what reads it twice, so no round computes the joins of an earlier one again.
        fitted = s.cut(few(left.join(sent(salted(least), n), ["bucket", "salt"]).where(fit).select(*MEMBER), n), f"fit-{i}")
        left, n = unsettled(fitted, labels, s, f"left-{i}", n)
        s.drop(f"fit-{i}", "measured" if i == 1 else f"rest-{i - 1}")
        if not n:
            break
        # The least edited classes lead first. Then the classes of the smaller components do: once they have,
        # what is left is one component.
        if i == 1:
            ranked = first_of(left, [F.col("own") / F.col("n"), F.col("cls")], LEADERS[0], dealt)
        else:
            sizes = left.groupBy("bucket", "comp").agg(F.count("*").alias("m"), F.max("salts").alias("salts"))
            ranked = first_of(left.join(sent(salted(sizes), n), ["bucket", "comp", "salt"]), [F.col("m"), F.col("cls")], LEADERS[min(i, len(LEADERS)) - 1], dealt)
        lead = ranked.select("bucket", "salts", F.col("cls").alias("l"), F.col("comp").alias("lc"), F.col("n").alias("ln"), F.col("own").alias("lo"), F.col("bits").alias("lb"))
        lead = s.cut(few(lead, n), f"lead-{i}")
        may = (F.col("comp") != F.col("lc")) & may_link(F.col("n"), F.col("own"), F.col("ln"), F.col("lo"), percent)
        may &= F.lit(100 + percent) * overlap_bound(F.col("n"), "bits", F.col("ln"), "lb") >= F.lit(percent) * (F.col("n") + F.col("ln"))
        pairs = left.join(sent(salted(lead), n, SENT // 10), ["bucket", "salt"]).where(may).select(F.least("l", "cls").alias("a"), F.greatest("l", "cls").alias("b")).distinct()
        new = s.cut(plausible(pairs.join(tried, ["a", "b"], "left_anti"), classes, percent), f"tried-{i}")
        found = new.count()
        edges = s.cut(few(confirmed(new, sets, percent), found), f"edges-{i}")
        tried = tried.unionByName(new)
        if not edges.isEmpty():
            named = labels.select(F.col("u").alias("k"), F.col("v").alias("c"))
            up = edges.join(named.toDF("a", "ca"), "a", "left").join(named.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("u"), F.coalesce("cb", "b").alias("v")).where("u <> v")
            more = components(up, s, f"cc-{i}", found).toDF("w", "to")
            moved = labels.join(more, labels.v == more.w, "left").select("u", F.coalesce("to", "v").alias("v"))
            known = labels.count() + more.count()
            labels = s.cut(few(moved.unionByName(more.join(labels, more.w == labels.u, "left_anti").toDF("u", "v")), known), f"labels-{i}")
        # Leaders have met everyone in their bucket.
        rest = left.join(sent(lead.select("bucket", F.col("l").alias("cls")), n), ["bucket", "cls"], "left_anti")
        left = s.cut(few(rest.select(*MEMBER), n), f"rest-{i}")
        n = left.count()
        s.drop(f"left-{i}", f"lead-{i}")

    comp = ids.join(labels.toDF("cls", "comp"), "cls", "left").select("cls", "min_id", F.coalesce("comp", "cls").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    comp = s.cut(few(comp.join(least, "comp").select("cls", "component_id"), docs_n), "comp")
    # Copies of one text may be a third of all rows: their class's row is sent to them.
    often = ids.where(F.col("copies") > hot_from(docs_n)).select("cls")
    out = join_hot(sig.select("doc_id", "n", "cls"), comp, "cls", often, "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id")))
    return s.last(out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies in docs: that with the least doc_id, those without one last.

    Each row is judged by its own text: a hash of doc_id and text stands for it, and doc_id only says which row of a
    group stays. Of rows that repeat a doc_id, that with the least hash does, and any one of rows that repeat both. docs
    is read several times, not copied, so it must give the same rows each time, as a table does."""
    s = Scratch(docs.sparkSession, "one")
    rows = docs.withColumn("__uid", F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), row_key()))
    ids = s.cut(rows.where("__uid is not null").select("__uid", "doc_id"), "ids")
    n = ids.count()
    again = s.cut(few(ids.groupBy("__uid").agg(F.count("*").alias("c")).where("c > 1").select("__uid"), n), "again")
    if not again.isEmpty():
        # One of each is written; the filter takes a few others for such rows, which stay as they are.
        marked = maybe_in(rows, "__uid", again, "__maybe").withColumn("__maybe", F.expr("__maybe and __uid is not null"))
        once = s.cut(marked.where("__maybe").drop("__maybe").dropDuplicates(["__uid"]), "once")
        rows = marked.where("not __maybe").drop("__maybe").unionByName(once)
        ids = ids.dropDuplicates(["__uid"])
    own = cluster(rows.where("__uid is not null").select(F.col("__uid").alias("doc_id"), "text")).select(F.col("doc_id").alias("__own"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("__uid"))
    ids = ids.select("__uid", order.alias("order"))
    # Only rows of groups of several are looked at again; all others stay where they are.
    several = own.groupBy("component_id").agg(F.count("*").alias("c")).where("c > 1")
    often = several.where(F.col("c") > hot_from(n)).select("component_id")
    grouped = join_hot(own, several.select("component_id"), "component_id", often, "left_semi")
    stay = grouped.join(ids, own["__own"] == ids["__uid"]).groupBy("component_id").agg(F.min("order")["__uid"].alias("__own"))
    gone = grouped.join(stay, "__own", "left_anti").select(F.col("__own").alias("__uid"))
    return minus(rows, "__uid", s.cut(few(gone, n), "gone")).drop("__uid")
