"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed byte n-grams (1 to 3 bytes, digits alike), of word bigrams that say the same
word twice (by how many and what share) and of the length's power of two. Each is scaled by the class
log-count ratio, rows are brought to unit length, and a linear hinge-loss model is fitted by dual
coordinate descent. A logistic curve over margins of rows held back from the fit turns margins into scores.

The fit reads a bounded sample of labelled rows (SAMPLE_ROWS expected), in one task; scoring is spread over
all rows. Defined cases: null and empty texts have no feature and get the score of a zero margin plus bias;
null labels are not learnt from; a document with several labels counts once for each; with one class or no
label at all every score is the share of label 1 (0.5 without labels); repeated rows get equal scores.
Whole texts are read, whatever their length. An input column named like the result's gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.columns import without
from lakespan.llm.words import raw_texts, word_hashes

BITS = 16
#: The last buckets are for indicators that aren't hashed.
OWN = 128
#: Expected most labelled rows that a model is fitted on.
SAMPLE_ROWS = 5_000
PASSES, COST, ALPHA = 12, 4.0, 1.0
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[48:58] = 48
_FOLD[9:14] = 32


def features(raw: bytes | None) -> np.ndarray:
    """Sorted distinct n-gram buckets of a whole text."""
    seen = np.zeros(1 << BITS, bool)
    for at in range(0, len(raw or b""), 1 << 20):
        a = _FOLD[np.frombuffer(raw[at : at + (1 << 20) + 2], np.uint8)]
        h = a + np.uint32(1)
        for n in range(3):
            if n:
                h = h[:-1] * np.uint32(257) + a[n:] + np.uint32(1)
            seen[((h * np.uint32(0x9E3779B1)) >> np.uint32(8)) % np.uint32((1 << BITS) - OWN)] = True
    words = word_hashes(raw or b"")
    twice = int((words[1:] == words[:-1]).sum())
    own = [min(40, len(raw or b"").bit_length())]
    own += [48 + min(15, twice.bit_length()), 64 + 32 * twice // len(words)] if twice else [47]
    seen[(1 << BITS) - OWN + np.array(own)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    weights: np.ndarray  # for each bucket, log-count ratio and model weight multiplied
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights[x].sum()) / (float(np.linalg.norm(self.ratios[x])) or 1.0) + self.bias

    def score(self, raw: bytes | None) -> float:
        return 1 / (1 + float(np.exp(np.clip(-self.slope * self.margin(features(raw)) - self.offset, -60, 60))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    p, q = np.full(1 << BITS, ALPHA), np.full(1 << BITS, ALPHA)
    for x, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[x] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """min 1/2 |w|^2 + sum cost_i * max(0, 1 - y_i (w.x_i + b)); the bias is a feature of value 1."""
    values = [ratios[x] for x in rows]
    values = [v / (np.linalg.norm(v) or 1.0) for v in values]
    w, bias, a = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    order, rng = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(PASSES):
        rng.shuffle(order)
        for i in order:
            x, v = rows[i], values[i]
            slack = y[i] * (w[x] @ v + bias) - 1
            new = min(max(a[i] - slack / 2.0, 0.0), cost[i])  # x_i has norm 1, and the bias adds 1
            if new != a[i]:
                step = (new - a[i]) * y[i]
                w[x] += step * v
                bias += step
                a[i] = new
    return w, bias


def curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    s, o = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(s * margins + o, -30, 30)))
        g, h = np.array([((p - t) * margins).sum(), (p - t).sum()]), p * (1 - p)
        hess = np.array([[(h * margins**2).sum(), (h * margins).sum()], [(h * margins).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        d = np.linalg.solve(hess, g)
        s, o = s - d[0], o - d[1]
        if abs(d).max() < 1e-7:
            break
    return float(s), float(o)


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    zero = np.zeros(1 << BITS)
    if len(set(y)) < 2:
        p = (0.5 if not len(y) else float((y > 0).mean())) * 0.998 + 0.001
        return Model(zero, zero, 0.0, 0.0, float(np.log(p / (1 - p))))
    held = np.arange(len(y)) % 4 == 3
    if min((y[held] > 0).sum(), (y[held] < 0).sum(), (y[~held] > 0).sum(), (y[~held] < 0).sum()) < 2:
        held = np.zeros(len(y), bool)

    def fitted(part: np.ndarray) -> Model:
        own, mine = [rows[i] for i in np.flatnonzero(part)], y[part]
        ratios = log_count_ratios(own, mine)
        cost = np.where(mine > 0, COST, COST * min(10.0, max(1.0, (mine > 0).sum() / (mine < 0).sum())))
        w, bias = dual_descent(own, mine, ratios, cost)
        return Model(w * ratios, ratios, bias, 1.0, 0.0)

    first = fitted(~held)
    judged = held if held.any() else ~held
    slope, offset = curve(np.array([first.margin(rows[i]) for i in np.flatnonzero(judged)]), y[judged])
    out = fitted(np.ones(len(y), bool))
    out.slope, out.offset = slope, offset
    return out


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on rows with a label, about sample_rows of them, chosen by a hash of key."""
    have = labelled.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), (F.col(label) > 0).cast("int").alias("y"))
    n = have.select("y").count()
    if n > sample_rows:
        have = have.where(F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 48)) < F.lit(int((1 << 48) * sample_rows / n)))

    def digest(batches):
        for b in batches:
            x = [features(r).astype(np.uint32 if BITS > 16 else np.uint16).tobytes() for r in raw_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary()), b.column(2)], ["k", "x", "y"])

    def learn(batches):
        got = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(got) if got else None
        rows, labels = [], np.zeros(0)
        if table is not None:
            table = table.sort_by([("k", "ascending"), ("y", "ascending"), ("x", "ascending")])
            rows = [np.frombuffer(x, np.uint32 if BITS > 16 else np.uint16).astype(np.int64) for x in table.column("x").to_pylist()]
            labels = np.array(table.column("y").to_pylist())
        m = train(rows, labels)
        yield pa.RecordBatch.from_arrays([pa.array([m.weights.astype(np.float32).tobytes()]), pa.array([m.ratios.astype(np.float32).tobytes()]), pa.array([[m.bias, m.slope, m.offset]])], ["w", "r", "s"])

    # repartition, not coalesce: the scan and the features stay spread, only the sample's features go to one task.
    one = have.mapInArrow(digest, "k long, x binary, y int").repartition(1).mapInArrow(learn, "w binary, r binary, s array<double>").collect()
    if not one:
        return train([], np.zeros(0))
    w, r = (np.frombuffer(bytes(one[0][c]), np.float32) for c in ("w", "r"))
    return Model(w, r, *one[0]["s"])


def rate(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs, and a column with the score of each whole text."""
    docs = without(docs, name)
    at = docs.columns.index(text)
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches):
        for b in batches:
            s = pa.array([model.score(r) for r in raw_texts(b.column(at))], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], [*names, "s"])

    kept = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    return docs.mapInArrow(run, f"{kept}, s double").toDF(*docs.columns, name)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").join(labels.where("quality is not null").select("doc_id", "quality"), "doc_id")


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """labelled(), but the labels are thinned to the bound before texts are joined to them."""
    labels = labels.where("quality is not null").select("doc_id", "quality")
    n = labels.count()
    if n > sample_rows:
        labels = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 48)) < F.lit(int((1 << 48) * sample_rows / n)))
    # The thinned labels are at most about sample_rows rows of two numbers, so they are sent to every task.
    return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = fit(sample(docs, labels), sample_rows=2 * SAMPLE_ROWS)
    out = rate(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """Documents that score at least least under a model fitted on the labels of docs."""
    model = fit(sample(docs, labels), sample_rows=2 * SAMPLE_ROWS)
    return rate(docs, model, name="__quality_score").where(F.col("__quality_score") >= least).drop("__quality_score")
