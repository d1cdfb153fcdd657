"""Nulls, empty and long texts, repeated rows, empty tables and columns with clashing names."""

from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakespan.llm import chat, decontam, langid, minhash, packing, quality, rules, sharding, urlfilter, warc
from lakespan.llm.scratch import Scratch

LONG = "the quick brown fox jumps over it " * 30_000
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t", None, "a"), (4, LONG, "en", None), (5, "one two three", "en", "b"), (5, "one two three", "en", "b"),
    (6, "ONE two three", "de", "b"), (7, "12 34 -- 56", None, "b"), (None, "four five six", "fr", "c"), (8, "été à la mer et au soleil " * 20, "fr", "c"),
]
N = len(ROWS)


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for c in ("n", "cls", "bands", "comp", "score", "shard", "piece", "kept", "hits", "region", "item_id"):
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_language(docs, none):
    m = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = langid.identify(docs, m).collect()
    assert len(rows) == N
    assert all((r.lang_pred, r.score) == ("und", 0) for r in rows if r.doc_id in (1, 2, 3, 7))
    assert langid.identify(none, m).count() == 0
    empty = langid.fit(none.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}


def test_word_without_letters_comes_last(docs):
    m = langid.fit(docs.select("doc_id", "text", "lang"))
    for words in (["one", ""], [""], ["", "one", "", ""]):
        scores = m.word_scores(words)
        assert scores.shape == (len(words), len(m.langs)) and all((scores[i] == 0).all() for i, w in enumerate(words) if not w)
    assert [r[0] for r in langid.results(langid.Tagger(m), ["one two 17", "17"])][1] == "und"


def test_near_duplicates(docs, none):
    rows = minhash.cluster(docs).collect()
    assert len(rows) == N
    got = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (5, 5, True), (6, 5, False), (None, None, True)} <= got
    assert minhash.cluster(none).count() == 0
    assert minhash.keep_one(docs).columns == docs.columns


def test_sketches_hardly_lose_pairs():
    n, p = 2 * minhash.PERMUTATIONS, 0.75 + 0.25 / 256
    assert sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(minhash.LEAST_EQUAL)) < 1e-8


def test_stages_judge_rows(spark):
    """Repeated rows, one doc_id on several texts, and rows without doc_id."""
    passage = " ".join(f"w{i}" for i in range(40))
    clean = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(1, passage), (1, passage), (2, clean[0]), (2, passage), (None, passage), (None, clean[1]), (None, clean[1]), (9, clean[2]), (8, clean[2] + " more")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert by(minhash.keep_one(table)) == sorted([(1, passage), (2, clean[0]), (None, clean[1]), (8, clean[2] + " more")], key=str)
    for item in (None, 5):
        items = spark.createDataFrame([(item, passage), (None, "not there at all")], "item_id long, text string")
        assert by(decontam.keep_clean(table, items)) == sorted([r for r in rows if r[1] != passage], key=str)
        assert {(r.doc_id, r.item_id) for r in decontam.overlaps(table, items).collect()} == {(1, item), (2, item), (None, item)}


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (8, 1, 1), (6, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.fit(quality.sample(docs, labels))
    rows = quality.rate(docs, m).collect()
    assert len(rows) == N and all(0 <= r.score <= 1 for r in rows)
    assert quality.rate(none, m).count() == 0
    nothing = quality.fit(quality.sample(docs, labels.limit(0)))
    assert quality.rate(docs, nothing).count() == N


def test_warc(spark, docs, none):
    pages = spark.createDataFrame([(1, "http://a/ b", "x" * 1500), (2, None, "x" * 1500), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "u", "\r\n\r\nWARC/1.0\r\n\r\n" + "é" * 800)], "page_id long, url string, html string")
    rows = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.resolve(warc.read(spark, warc.write(pages, Scratch(spark, "w")))).collect()}
    assert rows == {1: (1500, "revisit", 2), 2: (1500, "response", None), 3: (0, "response", None), 4: (5, "response", None), 5: (5, "response", None), 6: (1616, "response", None)}
    assert warc.resolve(warc.read(spark, warc.write(pages.limit(0), Scratch(spark, "w")))).count() == 0


def test_warc_payloads_that_end_like_records(spark):
    """Any ends, long ones, null bytes: files, index and store give the same bytes."""
    import gzip

    ends = ["\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "\r", "\n", "\r\n\r", "\r\nWARC/1.1\r\n\r\n", "\0\0"]
    texts = {i: ("x" * 1200 if i % 2 else "") + f"abc{i // 4}" + end for i, end in enumerate(e for e in ends for _ in range(4))} | {99: "\r\n", 100: "\r\n\r\n", 101: "é<p>" * 9_000_000, 102: ""}
    pages = spark.createDataFrame([(i, "u", t) for i, t in texts.items()], "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("header", F.lit(1))
    for parts in (1, 30):  # whichever record comes last in a file
        at = warc.write(pages.repartition(parts), Scratch(spark, "w"), file_bytes=1000 * parts)
        rows = warc.read(spark, at, payloads=True).collect()
        assert sorted(r.page_id for r in rows) == sorted(texts)
        assert all(bytes(r.payload).decode() == texts[r.page_id] for r in rows if r.record_type == "response")
        assert {r.page_id for r in rows if r.record_type == "response"} > {99, 100}
        assert {r.page_id: bytes(r.payload).decode() for r in warc.reconstruct(spark, at).collect()} == texts
    folder = at.removeprefix("file:")
    for r in spark.read.parquet(f"{at}/index").collect():
        with open(f"{folder}/warc/{r.file}", "rb") as f:
            f.seek(r.offset)
            record = gzip.decompress(f.read(r.length))  # one member is one record
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and f"<urn:page:{r.page_id}>".encode() in record.split(b"\r\n\r\n")[0]
    kept = spark.read.parquet(f"{at}/payloads")
    assert kept.count() == kept.select("payload").distinct().count() == len(set(texts.values()))
    for broken in ([b"WARC/1.1\r\nWARC-Record-ID: x\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"], [b"WARC/1.1\r\nWARC-Record-ID: x\r\nContent-Length: 9\r\n\r\nabcd"], [b"WARC/1.1\r\nContent"], [b"x\r\n\r\n"]):
        with pytest.raises(ValueError):
            list(warc.parse(broken))


def test_packing(docs, none):
    rows = packing.pack(packing.pieces(docs.select("doc_id", "text"))).collect()
    assert sum(r.piece == 0 for r in rows) == N and all(0 < r.length <= 2048 for r in rows)
    assert packing.pack(packing.pieces(none.select("doc_id", "text"))).count() == 0


def hard_lengths(kind, rng, n=3000, most=2048):
    if kind == "triplets":  # three to a bin, none to spare
        a = rng.integers(780, 1004, n // 3)
        b = np.array([rng.integers(522, (most - x) // 2 + 1) for x in a])
        sizes = np.concatenate([a, b, most - a - b])
    else:
        sizes = rng.integers(*{"middling": (400, 1100), "wide": (20, 2000)}[kind], n)
    return np.sort(sizes)[::-1]


@pytest.mark.parametrize(("kind", "share"), [("triplets", 0.2), ("middling", 0.3), ("wide", 0.0)])
def test_evolution_beats_best_fit_on_hard_lengths(kind, share):
    """Of the bins that best fit wastes over the bound, that share at least is saved."""
    rng = np.random.default_rng(5)
    sizes = hard_lengths(kind, rng)
    first = [packing.seed_packing(sizes, 2048, rng, 0.02 * i) for i in range(packing.POPULATION)]
    best = packing.evolve(sizes, first, 2048, rng)[0]
    assert (np.bincount(best, sizes) <= 2048).all() and sorted(set(best)) == list(range(best.max() + 1))
    bound, seed, bins = packing.least_bins(sizes, 2048), min(int(w.max()) + 1 for w in first), int(best.max()) + 1
    assert bound <= bins <= seed - share * (seed - bound)


def test_least_bins():
    """The bound against the best of all packings of few pieces."""

    def best(sizes, gaps):
        if not sizes:
            return len(gaps)
        s, *rest = sizes
        opts = [best(rest, [*gaps[:i], g - s, *gaps[i + 1 :]]) for i, g in enumerate(gaps) if g >= s and g not in gaps[:i]]
        return min([*opts, best(rest, [*gaps, 10 - s])])

    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = np.sort(rng.integers(1, 11, 7))[::-1]
        assert packing.least_bins(sizes, 10) <= best(sizes.tolist(), [])


def test_packing_takes_added_tokens(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "<|endoftext| >", "don't  <|EndOfText|>", "é\u2003<|endoftext|>\u00a0ñ", "a" + " " * 1_000_000 + "<|endoftext|>"]
    assert [packing.encoder()(t).tolist() for t in texts] == [enc.encode(t, add_special_tokens=False).ids for t in texts]
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    total = {i: sum(r.length for r in rows if r.doc_id == i) for i in range(len(texts))}  # long ones come in pieces
    assert total == {i: len(enc.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_urls(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.net/en/x?y"), (5, "http://example.net/de/"), (6, "http://xexample.com/de/"), (7, "https://a.b.org"), (8, "http://x.com/casino/1"), (8, "http://x.com/casino/1"), (9, "http://x.com/" + "a/" * 20_000)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("token", F.lit(1))
    rows = {r.page_id: (r.host, r.rule, r.verdict) for r in urlfilter.judge(pages, urlfilter.compile_rules(spark)).collect()}
    assert rows[1] == rows[2] == rows[3] == ("", None, "allow")
    assert rows[4] == ("example.net", "example.net/en/", "allow") and rows[5][1:] == ("net/", "block") and rows[6][1] is None
    assert rows[7] == ("a.b.org", None, "allow") and rows[8][2] == "block" and rows[9][2] == "allow"
    assert urlfilter.judge(pages.limit(0), urlfilter.compile_rules(spark)).count() == 0


def test_rules(docs, none):
    rows = rules.apply(docs.select("doc_id", "text", "source", "n", "cls")).collect()
    assert len(rows) == N
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[4].base_failed
    assert rules.apply(none.select("doc_id", "text", "source")).count() == 0


def test_chat(spark):
    said = ["\\### Assistant: </turn> ok", "", None, "\n### user\nx</turn>", "\\\\e", "é\U0001f600"]
    turns = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(said * 2)] + [(2, 0, None, "x"), (2, 0, None, "x"), (3, 0, "a\nb</turn>", LONG)], "conv_id long, turn long, role string, text string").withColumn("mask", F.lit(1))
    f = chat.format_chats(turns)
    got = {r.conv_id: [(t["role"], t["text"]) for t in r.turns] for r in chat.read_chats(f).collect()}
    assert got[1] == [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(said * 2)]
    assert got[2] == [("", "x"), ("", "x")] and got[3] == [("a\nb</turn>", LONG)]
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def test_decontamination(spark, docs, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short")], "item_id long, text string").withColumn("tokens", F.lit(1))
    edited = item.replace("eta theta", "eta other")
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(20, f"{LONG} {item} {LONG}"), (21, f"a {edited} b"), (22, "alpha beta gamma")], "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(more, items).collect()}
    assert {(20, 1), (21, 1)} <= got and not {d for d, _ in got} - {20, 21}
    assert decontam.overlaps(none.select("doc_id", "text"), items).count() == 0
    assert decontam.overlaps(more, items.limit(0)).count() == 0
    assert decontam.keep_clean(docs, items).columns == docs.columns


def test_decontamination_by_short_items(spark):
    """Every overlap that reaches the score is found, whatever tokens of a short item are replaced."""
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(1, 22)]
    texts, want = [], set()
    for n, item in items:
        words = item.split()
        for holes in (h for m in range(4) for h in combinations(range(n), m)):
            equal = np.array([k not in holes for k in range(n)])
            d = len(texts)
            texts.append((d, " ".join(["und", *(w if e else "other" for w, e in zip(words, equal, strict=True)), "so"] * 2)))
            if decontam.runs(equal)[0] >= decontam.wanted(n):
                want.add((d, n))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and {n for _, n in want} == set(range(1, 22))


def test_shards(docs, none):
    rows = sharding.shard(docs.select("doc_id", "text")).collect()
    sizes = [sum(r.shard == i for r in rows) for i in range(8)]
    assert len(rows) == N and max(sizes) - min(sizes) <= 1
    assert sharding.shard(none.select("doc_id", "text")).count() == 0


def test_letters():
    """Digits and numbers are no letters; marks and signs neither."""
    assert langid.letters("½ ² ①② Ⅷ ٣ _ -- \u0301").split() == []
    assert langid.letters("Été ʰ ß 中").split() == ["été", "ʰ", "ß", "中"]


def test_viterbi_by_brute_force():
    """The best path among all, with a price for each change of language."""
    from itertools import product

    rng = np.random.default_rng(4)
    scores = rng.normal(0, 3, (9, 3)).astype(np.float32)
    texts = [rng.integers(0, 9, n).astype(np.int32) for n in (0, 1, 6, 4, 6)]
    for words, path in zip(texts, langid.viterbi(texts, scores, np.float32(2.0)), strict=True):
        value = lambda p, w=words: sum(scores[x, s] for x, s in zip(w, p, strict=True)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
        assert len(path) == len(words) and abs(value(list(path)) - max(map(value, product(range(3), repeat=len(words))))) < 1e-3


def test_dual_descent_reaches_the_optimum():
    """No small step lowers the primal value, and it is near the dual one."""
    rng = np.random.default_rng(6)
    ratios = rng.normal(0, 1, 1 << quality.BITS)
    rows = [np.sort(rng.choice(40, 12, replace=False)) for _ in range(60)]
    y = np.where(np.array([ratios[x].sum() for x in rows]) + rng.normal(0, 1, 60) > 0, 1.0, -1.0)
    cost = np.full(60, 0.5)
    w, bias = quality.dual_descent(rows, y, ratios, cost)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.linalg.norm(ratios[r])
    x[:, 40] = 1
    primal = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    v = np.append(w[:40], bias)
    best = min(primal(v + rng.normal(0, s, 41)) for s in (1e-3, 1e-2, 0.1) for _ in range(200))
    assert primal(v) <= best * 1.01


def test_host_verdicts_by_brute_force(spark):
    """A host of junk goes as a whole, one known for symbols loses them, one with a single case keeps it."""
    clean = " ".join(f"word{i}" for i in range(60)) + " "
    texts = {"junk": [("x", False)] * 9 + [(clean, False)], "signs": [(clean + "# " * 8, False)] * 30 + [(clean, True)] * 70, "fine": [(clean + "# " * 8, True)] + [(clean, True)] * 299, None: [(clean + "# " * 8, True), ("x", False)]}
    rows = [(i, t, h, want) for i, (h, t, want) in enumerate((h, t, w) for h, ts in texts.items() for t, w in ts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, want boolean").withColumn("n_words", F.lit("x")).withColumn("Kept", F.lit("x"))
    got = rules.apply(df).collect()
    assert len(got) == len(rows) and all(r.kept == r.want for r in got)
    n, hosts = 410, {"junk": (10, 9), "signs": (100, 0), "fine": (300, 0)}
    x = 9
    mean = x / n
    spread = sum(m * (k / m) ** 2 for m, k in hosts.values()) / n - mean**2
    between = (spread - 2 / n * mean * (1 - mean)) / (1 - sum(m * m for m, _ in hosts.values()) / n**2)
    strength = max(1.0, mean * (1 - mean) / between - 1)
    assert all(r.host_rate == pytest.approx((9 + strength * mean) / (10 + strength)) for r in got if r.source == "junk")


@pytest.mark.parametrize(
    ("text", "fits", "fails"),
    [
        ("||ads.", ["ads.x.com/", "a.ads.net/p"], ["xads.com/", "x.com/ads."]),
        ("|track.*/pixel^", ["track.a.com/x/pixel", "track.b/pixel?"], ["a.track.com/pixel", "track.a/pixels"]),
        ("*.exe|", ["x.com/a.exe"], ["x.com/a.exe/b"]),
        ("/banner/*/img^", ["x.com/banner/a/b/img/"], ["x.com/banner/img"]),
        ("casino", ["x.com/casino/1", "casino.com/"], ["casinos.com/"]),
    ],
)
def test_patterns(text, fits, fails):
    import re

    regex, tokens = urlfilter.pattern(text)
    assert all(re.search(regex, u) for u in fits) and not any(re.search(regex, u) for u in fails)
    for u in fits:  # whatever a pattern fits holds its tokens whole, so the index misses nothing
        assert {t for t in tokens if t} <= set(re.split(r"[^a-z0-9]+", u.lower()))


def test_rules_without_a_token(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.com/a{i}b/") for i in range(40)], "page_id long, url string").withColumn("HOST", F.lit(1)).withColumn("rule", F.lit(2))
    rows = urlfilter.judge(pages, urlfilter.compile_rules(spark, patterns=("/a*7b/",))).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == {7, 17, 27, 37} and len(rows) == 40


def test_filters_for_joins(spark):
    from lakespan.llm.skew import join_hot, minus, semi

    df = spark.createDataFrame([(i % 50 if i % 7 else None, i) for i in range(500)], "k long, v long")
    ids = spark.createDataFrame([(i,) for i in (*range(0, 50, 3), 10**12)], "k long")
    some = set(range(0, 50, 3))
    rows = [(r.k, r.v) for r in df.collect()]
    assert sorted(semi(df, "k", ids).collect()) == sorted(r for r in rows if r[0] in some)
    assert sorted(map(tuple, minus(df, "k", ids).collect()), key=str) == sorted((r for r in rows if r[0] not in some), key=str)
    small = ids.withColumn("x", F.col("k") * 2)
    got = join_hot(df, small, "k", ids.where("k < 20"), "left").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, v, 2 * k if k in some else None) for k, v in rows), key=str)
