"""Language identification: script ranges, per-word scores, Viterbi spans.

A model is learnt from labelled texts: hashed letter trigrams per language, counted by Spark over a
sample of documents with a bounded expected size. A word's script narrows its candidate languages; a
Viterbi pass with a switching penalty then labels spans of words, so mixed texts get several spans.

Defined cases: null, empty or letterless text is ``und`` with score 0 and no spans; null labels are
not learnt from; repeated rows get equal predictions; ties go to the language first in order; with no
labelled text at all everything is ``und``. A letter is what Unicode calls one: digits and numbers aren't. Whole
texts are read, whatever their length. Input columns named like those of the result give way to them.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.columns import without

UND = "und"
BUCKETS = 1 << 16
#: Expected most documents that a model is learnt from.
SAMPLE_DOCS = 12_000
#: What a change of language costs, in nats.
SWITCH = 6.0
#: A short text may fall short of its language's mean score by so many deviations of its length.
DEVIATIONS = 6.0
#: Least share of the letters and least confidence of a text whose language can be told.
LEAST_SHARE, LEAST_SURE = 0.55, 0.5
#: First and last code point of ranges by script. 0 stands for any other script.
SCRIPTS = (
    (0x0041, 0x024F, 1), (0x0370, 0x03FF, 2), (0x0400, 0x052F, 3), (0x0530, 0x058F, 4), (0x0590, 0x05FF, 5), (0x0600, 0x06FF, 6),
    (0x0900, 0x097F, 7), (0x0980, 0x09FF, 8), (0x0E00, 0x0E7F, 9), (0x10A0, 0x10FF, 10), (0x1E00, 0x1EFF, 1), (0x3040, 0x30FF, 11),
    (0x3400, 0x9FFF, 12), (0xAC00, 0xD7AF, 13),
)
N_SCRIPTS = 14
_STARTS = np.array([x for a, b, _ in SCRIPTS for x in (a, b + 1)])
_KINDS = np.array([0] + [x for _, _, s in SCRIPTS for x in (s, 0)])
_NOT_LETTER = re.compile(r"[^\w\s]|[\d_]")


def _numbers() -> re.Pattern:
    r"""Numbers such as ½ and ① that aren't digits: \w takes them as well as letters."""
    at = [i for i in range(128, sys.maxunicode + 1) if chr(i).isalnum() and not chr(i).isalpha() and not chr(i).isdecimal()]
    cuts = [0, *(k for k in range(1, len(at)) if at[k] != at[k - 1] + 1), len(at)]
    return re.compile("[" + "".join(f"{chr(at[a])}-{chr(at[b - 1])}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)) + "]")


_NUMBER = _numbers()


def letters(text: str) -> str:
    """Lower case, only letters and white space."""
    text = _NOT_LETTER.sub("", text.lower())
    return text if text.isascii() else _NUMBER.sub("", text)


def script_of(points: np.ndarray) -> np.ndarray:
    return _KINDS[np.searchsorted(_STARTS, points, "right")]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of words of letters, each framed by blanks; where each word's begin; its script."""
    p = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = (p[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ p[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) + p[2:] * np.uint64(0x165667B19E3779F9)
    h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1  # trigram i is centred on code point i + 1
    first = p[1:][np.minimum(starts, len(p) - 2)]
    return h.astype(np.int64), starts, np.where(sizes > 0, script_of(first), 0)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages, log probabilities
    scripts: np.ndarray  # N_SCRIPTS x languages, whether the language is written so
    gain: np.ndarray  # by language: mean and deviation of what its own trigrams score above the background
    spread: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row for each word of letters; an empty word scores 0 everywhere."""
        return self.judged(words)[0]

    def judged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """word_scores, less the best language's log probability, and that: the second part is by word."""
        h, starts, script = grams(words)
        g = np.zeros((len(h) + 1, self.weights.shape[1]), self.weights.dtype)  # an empty last word begins behind the last trigram
        g[:-1] = self.weights[h]
        g[(starts[1:] - 1)] = 0  # trigrams across two words
        out = np.add.reduceat(g, starts, axis=0)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        top = out.max(1)
        out -= top[:, None]
        out[~self.scripts[script]] -= 50.0
        out[sizes == 0] = top[sizes == 0] = 0
        return out.astype(np.float32), top

    def confidence(self, lang: int, letters: int, likelihood: float) -> float:
        """How well a text of so many letters is explained: 1 as its language's own texts are, 0 as letters drawn
        from BUCKETS trigrams alike are. A text whose shortfall is DEVIATIONS of such a length's gets 0.5 at least."""
        short = self.gain[lang] - (likelihood / letters + np.log(BUCKETS))
        allowed = max(self.gain[lang] / 2, DEVIATIONS * self.spread[lang] / letters**0.5, 1e-9)
        return float(np.clip(1 - short / (2 * allowed), 0, 1))


class Tagger:
    """Labels texts; word scores are kept between batches, up to a bound."""

    KEEP = 300_000

    def __init__(self, model: Model, switch: float = SWITCH):
        self.m, self.switch = model, np.float32(switch)
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.m.langs)), np.float32)
        self.tops = np.zeros(0)
        self.sizes = np.zeros(0, np.int32)

    def lookup(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.ids) > self.KEEP:
            self.clear()
        ids, out, known = self.ids, [], len(self.ids)
        for t in texts:
            out.append(np.fromiter((ids.setdefault(w, len(ids)) for w in (t or "").split()), np.int32))
        if len(ids) > known:
            new = list(ids)[known:]
            clean = [re.sub(r"\s", "", x) for x in letters("\n".join(new)).split("\n")] if known or new else []
            scores, tops = self.m.judged(clean)
            self.scores, self.tops = np.concatenate([self.scores, scores]), np.concatenate([self.tops, tops])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, clean), np.int32, len(clean))])
        return out

    def label(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """For each text: the language index of each word, how many letters the word has, and the text's log
        probability in these languages."""
        words = self.lookup(texts)
        paths = viterbi(words, self.scores, self.switch)
        return [(p, self.sizes[w], float(self.scores[w, p].sum(dtype=float) + self.tops[w].sum())) for p, w in zip(paths, words, strict=True)]


def viterbi(docs: list[np.ndarray], scores: np.ndarray, switch: np.float32) -> list[np.ndarray]:
    """The best state of each word; all documents advance together, the longest first."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    sizes = np.array([len(docs[i]) for i in order] or [0])
    longest = int(sizes[0])
    if not longest:
        return [np.zeros(0, np.int16) for _ in docs]
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # documents with more than t words
    begin = np.concatenate([[0], np.cumsum(active)])
    flat = np.empty(begin[-1], np.int32)  # word ids by time, then document
    for k, i in enumerate(order):
        if len(docs[i]):
            flat[begin[: len(docs[i])] + k] = docs[i]
    n_states = scores.shape[1]
    jump = np.empty(len(flat), np.int16)  # the best state before each word, for those that switch
    stays = np.empty((len(flat), n_states), bool)
    v = np.zeros((active[0], n_states), np.float32)
    final = np.empty(active[0], np.int16)
    for t in range(longest):
        n = active[t]
        if n < len(v):
            final[n : len(v)] = v[n:].argmax(1)
            v = v[:n]
        best = v.argmax(1)
        v = v - v[np.arange(n), best][:, None]
        stay = v >= -switch
        jump[begin[t] : begin[t + 1]], stays[begin[t] : begin[t + 1]] = best, stay
        v = np.where(stay, v, -switch) + scores[flat[begin[t] : begin[t + 1]]]
    final[: len(v)] = v.argmax(1)
    path = np.empty(len(flat), np.int16)
    state = np.empty(0, np.int16)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        if n > len(state):
            state = np.concatenate([state, final[len(state) : n]])
        part = slice(begin[t], begin[t + 1])
        path[part] = state
        state = np.where(stays[part][np.arange(n), state], state, jump[part])
    out: list = [None] * len(docs)
    for k, i in enumerate(order):
        out[i] = path[begin[: len(docs[i])] + k]
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from rows with text and label. About sample_docs of them are used, chosen by a hash of key.

    The counts that reach the driver are bounded by BUCKETS x languages.
    """
    have = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"), F.col(key).alias("k"))
    n = have.select("l").count()  # reads no text; rows without one only make the sample a little smaller
    if n > sample_docs:
        have = have.where(F.pmod(F.xxhash64("k"), F.lit(1 << 48)) < F.lit(int((1 << 48) * sample_docs / n)))
    have = have.where("t is not null")

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                words = letters(t.as_py()).split()
                if words:
                    c = seen.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                    h, starts, script = grams(words)
                    across = np.ones(len(h), bool)
                    across[starts[1:] - 1] = False
                    c[:BUCKETS] += np.bincount(h[across], minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(script, minlength=N_SCRIPTS)
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], ["lang", "bucket", "n"])

    rows = have.select("t", "l").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    c = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    c[rows["bucket"].to_numpy(), np.searchsorted(langs, rows["lang"].to_numpy(str))] = rows["n"].to_numpy()
    seen = c[:BUCKETS] + 0.05
    share = c[BUCKETS:] / np.maximum(c[BUCKETS:].sum(0), 1)
    scripts = share > 0.01
    scripts[~scripts.any(1)] = True  # unseen scripts leave every language
    p = seen / seen.sum(0)
    above = np.log(p * BUCKETS)
    gain = (p * above).sum(0)
    return Model(langs, np.log(p).astype(np.float32), scripts, gain, np.sqrt((p * (above - gain) ** 2).sum(0)))


def results(tagger: Tagger, texts: list[str | None]):
    """For each text: language, score, spans (language, first word, words) and confidence."""
    langs = tagger.m.langs
    if not langs:
        return [(UND, 0.0, [], 0.0) for _ in texts]
    out = []
    for path, size, likelihood in tagger.label(texts):
        total = int(size.sum())
        if not total:
            out.append((UND, 0.0, [], 0.0))
            continue
        share = np.bincount(path, size, minlength=len(langs))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
        spans = [{"lang": langs[path[a]], "first_word": int(a), "n_words": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        best = int(share.argmax())
        out.append((langs[best], float(share[best] / total), spans, tagger.m.confidence(best, total, likelihood)))
    return out


#: Bytes of text that are labelled at once.
PORTION = 6_000_000
SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))


def identify(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, ...] = ("lang_pred", "score", "spans", "confidence"), switch: float = SWITCH) -> DataFrame:
    """docs, and four columns: the language, its share of the letters, the spans of words, and the confidence."""
    docs = without(docs, *names)
    at = docs.columns.index(text)

    def run(batches):
        tagger = Tagger(model, switch)
        for b in batches:
            first = 0
            sizes = np.cumsum([0, *(len(x or "") for x in b.column(at).to_pylist())])
            while first < b.num_rows:
                last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + PORTION, "right")) - 1)
                part = b.slice(first, last - first)
                lang, score, spans, sure = zip(*results(tagger, part.column(at).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, SPANS), pa.array(sure, pa.float64())], [*map(str, range(part.num_columns)), *"lsnc"])
                first = last

    kept = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    out = docs.mapInArrow(_renamed(run, len(docs.columns)), f"{kept}, lang string, score double, spans array<struct<lang:string,first_word:long,n_words:long>>, confidence double")
    return out.toDF(*docs.columns, *names)


def _renamed(run, n: int):
    names = [*(f"c{i}" for i in range(n)), "lang", "score", "spans", "confidence"]

    def go(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names)

    return go


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def keep_identified(spark: SparkSession, docs: DataFrame, least: float = LEAST_SHARE, sure: float = LEAST_SURE) -> DataFrame:
    """Documents whose language is known, holds at least that share of the letters, and explains the text: those in
    other languages or none, and mixtures without a clear majority, go."""
    model = fit(docs.select("doc_id", "text", "lang"))
    out = identify(docs, model, names=("__lang_pred", "__lang_score", "__lang_spans", "__lang_sure"))
    return out.where((F.col("__lang_pred") != UND) & (F.col("__lang_score") >= least) & (F.col("__lang_sure") >= sure)).drop("__lang_pred", "__lang_score", "__lang_spans", "__lang_sure")
