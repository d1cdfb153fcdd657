"""Quality rules per document, weighed by what their hosts show.

Counts over each whole text decide the rules of RULES. Failures of each rule are summed by host (documents'
source), and each host's failure rate is shrunk towards the whole by a beta prior that is fitted by moments to the
hosts' own rates for that rule. The shrunk rates are joined back to documents as verdicts:

- a host where most documents fail some rule (MOST_FAILING) is out with all of its documents;
- elsewhere documents that fail a rule go, as that host is known for such failures,
- unless its rate is below VOUCHED: there failures are single cases of a host that is otherwise clean, and stay.

The base rule takes documents out whatever their host shows.

Defined cases: a null text has no words and fails the base rule; documents without source belong to no host, so
only the base rule takes them out; repeated rows count each; one host alone, or hosts of equal rates, give a prior
as strong as all their documents together (at most STRONGEST); rates that tie with a limit are above it; an empty
table gives an empty result; input columns named like those of the result give way to them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.columns import without
from lakespan.llm.scratch import Scratch
from lakespan.llm.words import _BASE, _BYTE, _INV, finish, powers, raw_texts, windows, word_spans

LEAST_WORDS, MOST_REPEAT = 50, 50
#: Shrunk failure rate of any rule from which a host is out, and that from which its failing documents are.
MOST_FAILING, VOUCHED = 0.5, 0.02
#: Most documents that the prior may weigh as much as.
STRONGEST = 1000.0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Rules besides the base rule, over COUNTS: many symbols, many lines twice, and words far too short or long.
SOFT = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "20 * n_dup_lines > n_words",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(raw: bytes | None) -> tuple[int, int, int, int, int]:
    """The numbers of COUNTS for a whole text."""
    a, start, _ = word_spans(raw or b"")
    if not len(start):
        return 0, 0, int(_SYMBOL[a].sum()), 0, 0
    chars = int(((_BYTE[a] != 0) & ((a & 0xC0) != 0x80)).sum())
    seen, doubled = set(), 0
    for line in raw.split(b"\n"):
        if not line.strip(b" \t\r\x0b\x0c"):
            continue
        doubled += line in seen
        seen.add(line)
    repeat = 0
    if len(start) > 3:
        h = finish(np.add.reduceat(_BYTE[a] * powers(_BASE, len(a)), start) * powers(_INV, len(a))[start])
        w = windows(h, 3)
        order = np.argsort(w)
        same = w[order][1:] == w[order][:-1]
        again = np.zeros(len(w) + 2, bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        repeat = int((again | np.roll(again, 1) | np.roll(again, 2)).sum())
    return len(start), chars, int(_SYMBOL[a].sum()), doubled, repeat


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the text replaced by COUNTS and base_failed."""
    at = docs.columns.index(text)
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches):
        for b in batches:
            got = [counts(raw) for raw in raw_texts(b.column(at))]
            cols = zip(*got, strict=True) if got else [[]] * 5
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), *(pa.array(c, pa.int64()) for c in cols)], [*(f"c{i}" for i in rest), *COUNTS])

    kept = "".join(f"c{i} {docs.schema[i].dataType.simpleString()}, " for i in rest)
    out = docs.mapInArrow(run, kept + ", ".join(f"{c} long" for c in COUNTS)).toDF(*(docs.columns[i] for i in rest), *COUNTS)
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words")))


def failures() -> dict:
    """Each rule as a column over COUNTS and base_failed; a text without words fails none but the base rule."""
    return {"base": F.col("base_failed")} | {name: (F.col("n_words") > 0) & F.expr(rule) for name, rule in SOFT.items()}


def prior(n: int, x: int, hosts: int, npp: float, nn: float) -> tuple[float, float]:
    """Mean and strength of a beta prior over hosts' rates: n documents, x failures, npp the sum of n_h * p_h^2, nn that
    of n_h^2."""
    mean, strength = (x / n if n else 0.0), STRONGEST
    if n and hosts > 1 and 0 < mean < 1:
        # Weighted moments: the variance between hosts beyond what binomial draws of their sizes give.
        spread = npp / n - mean * mean
        chance = (hosts - 1) / n * mean * (1 - mean)
        between = (spread - chance) / max(1e-12, 1 - nn / n / n)
        if between > 0:
            strength = max(1.0, mean * (1 - mean) / between - 1)
    return mean, min(STRONGEST, strength, float(max(n, 1)))


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """(host, host_docs, host_rate, host_kept, bad): bad is a struct that says of each rule whether failing it counts
    there; host_rate is the highest of the shrunk rates."""
    fails = failures()
    by = measured.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("n"), *(F.sum(f.cast("long")).alias(f"x_{k}") for k, f in fails.items()))
    n = F.col("n").cast("double")
    squares = [F.sum(F.col(f"x_{k}") * F.col(f"x_{k}") / n).alias(f"npp_{k}") for k in fails]
    sums = by.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), F.sum(n * n).alias("nn"), *(F.sum(f"x_{k}").alias(f"x_{k}") for k in fails), *squares).first()
    rates = {}
    for k in fails:
        mean, strength = prior(sums["n"] or 0, sums[f"x_{k}"] or 0, sums["hosts"], sums[f"npp_{k}"] or 0.0, sums["nn"] or 0.0)
        rates[k] = (F.col(f"x_{k}") + F.lit(strength * mean)) / (F.col("n") + F.lit(strength))
    worst = F.greatest(*rates.values())
    bad = F.struct(*((rates[k] >= VOUCHED).alias(k) for k in SOFT))
    return by.select(host, F.col("n").alias("host_docs"), worst.alias("host_rate"), (worst < MOST_FAILING).alias("host_kept"), bad.alias("bad"))


def judged(measured: DataFrame, host: str = "source") -> DataFrame:
    """measured with host_rate and kept. measured is read twice: by host, and for the join."""
    verdicts = host_verdicts(measured, host).select(F.col(host).alias("__host"), F.col("host_rate").alias("__rate"), "host_kept", "bad")
    out = measured.join(verdicts, measured[host] == verdicts["__host"], "left")
    counts_there = [f & F.coalesce(F.col(f"bad.{k}"), F.lit(False)) for k, f in failures().items() if k != "base"]
    fails = counts_there[0]
    for c in counts_there[1:]:
        fails = fails | c
    kept = ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True)) & ~fails
    return out.select(*(measured[c] for c in measured.columns), F.col("__rate").alias("host_rate"), kept.alias("kept"))


RESULTS = (*COUNTS, "base_failed", "host_rate", "kept")


def apply(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """docs without text, with COUNTS, base_failed, host_rate and kept."""
    own = without(docs.select(F.col(text).alias("__text"), F.col(host).alias("__source"), *(docs[c] for c in docs.columns if c != text)), *RESULTS)
    measured = Scratch(docs.sparkSession, "rules").cut(measure(own, "__text"), "measured")
    return judged(measured, "__source").drop("__source")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept")
