"""URL filtering: rules indexed by their rarest literal token.

Every rule has a regular expression over host and path, and literal tokens that each url it fits must hold.
The token that the fewest urls hold is its key. Tokens of distinct urls fetch candidate rules by a join, and
only candidates run their regular expressions. A rule without a literal token is a candidate for every url: it is
kept once under each of ANYWHERE further tokens, of which each url holds one, so no key meets all urls in one task.

Patterns: `||` at the start anchors at the host or a subdomain of it, `|` at either end at the start of the host and
at the end of the path; `*` stands for any characters, `^` for one that is no letter, digit, `_`, `-`, `.` or `%`, or for
the end. A pattern without any of these signs is a word, with no letter or digit next to it.

Listed rules (host and path prefix) go before patterns, the longest first; patterns decide only where no
listed rule fits. Defined cases: a null url or one without :// has empty host and path, fits no rule and is
allowed; repeated urls are judged once and get equal verdicts; of patterns that fit, the longest is named, of equally
long ones the last in order; whole urls are read, whatever their length; an empty table gives an empty result; input
columns named like those of the result give way to them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespan.llm.columns import without

#: Verdict and rule, a host and a path prefix.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words and patterns in a host or path that block a page.
PATTERNS = ("cheap-pills", "spam-farm", "casino", "free-download", "adserver", "||m.*.html|", "|track.*/pixel^", "/banner/*/img^", "*.exe|", "||*.zip^")
#: Names of servers that come by number, up to SERVERS of each.
SERVED, SERVERS = ("ads", "banner", "click", "count", "img-ad", "pop", "promo", "spam", "stat", "track"), 25
#: A rule index is sent to every task only up to that many rows (under 10 MB); beyond, it is joined by shuffle.
MOST_SENT = 50_000
#: Tokens for rules without a literal one; no url holds them of itself.
ANYWHERE = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"[^a-z0-9]+"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def pattern(text: str) -> tuple[str, list[str]]:
    """A pattern's regular expression, and the tokens that all it fits must hold whole."""
    if not re.search(r"[|*^]", text):
        return rf"(?:^|[^a-zA-Z0-9]){re.escape(text)}(?:[^a-zA-Z0-9]|$)", re.split(_SPLIT, text.lower())
    body, start, end = text, "", ""
    if body.startswith("||"):
        body, start = body[2:], r"^(?:[^/]*\.)?"
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], "$"
    signs = {"*": ".*", "^": "(?:[^a-zA-Z0-9_.%-]|$)"}
    regex = start + "".join(signs.get(c) or re.escape(c) for c in body) + end
    # A token is whole where its neighbours are known: an anchor, a ^, or another character of the pattern.
    edges = ("^" if start else "*") + body.lower() + ("^" if end else "*")
    return regex, re.findall(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", edges)


def numbered(served=SERVED, servers: int = SERVERS) -> list[str]:
    """Patterns for hosts whose first label is a server's name and number."""
    return [f"||{name}{i}." for name in served for i in range(1, servers + 1)]


def compile_rules(spark: SparkSession, listed=LISTED, patterns=(*PATTERNS, *numbered())) -> DataFrame:
    """(rule, verdict, regex, rank, tokens): rank orders listed rules by length, patterns below them."""
    rows = []
    for verdict, rule in listed:
        host, slash, path = rule.partition("/")
        ends = path if path.endswith("/") else path.rpartition("/")[0]
        tokens = re.split(_SPLIT, f"{host}/{ends}".lower())
        rows.append((rule, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", 1_000_000 + len(rule), sorted({t for t in tokens if t})))
    for p in patterns:
        regex, tokens = pattern(p)
        rows.append((p, "block", regex, len(p), sorted({t for t in tokens if t})))
    return spark.createDataFrame(rows, "rule string, verdict string, regex string, rank long, tokens array<string>")


def index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """rules with their key: the token that fewest urls hold. tokens: (token), one row for each url that has it."""
    own = rules.select("rule", F.explode("tokens").alias("token"))
    wanted = own.select("token").distinct()
    found = tokens.join(F.broadcast(wanted) if wanted.limit(MOST_SENT + 1).count() <= MOST_SENT else wanted, "token").groupBy("token").agg(F.count("*").alias("df"))
    best = own.join(found, "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("df", F.lit(0)), "token"))["token"].alias("key"))
    return rules.join(best, "rule", "left").select("rule", "verdict", "regex", "rank", "key")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """pages with host, path, rule (null unless a listed rule decides), pattern (likewise) and verdict."""
    pages = without(pages, "host", "path", "rule", "pattern", "verdict")
    parts = with_parts(pages.select(url).distinct(), url)
    target = F.concat("host", "path")
    words = F.array_distinct(F.split(F.lower(target), _SPLIT))
    tokens = parts.select(url, target.alias("target"), F.explode(F.array_append(F.filter(words, lambda t: t != ""), _anywhere(F.pmod(F.xxhash64(url), F.lit(ANYWHERE))))).alias("key"))
    keyed = index(rules, tokens.select(F.col("key").alias("token")))
    own = F.when(F.col("key").isNull(), F.transform(F.sequence(F.lit(0), F.lit(ANYWHERE - 1)), _anywhere)).otherwise(F.array("key"))
    keyed = keyed.withColumn("key", F.explode(own))
    small = rules.limit(MOST_SENT + 1).count() <= MOST_SENT
    if small:  # so few rules that the driver may hold them: the index is made once
        keyed = F.broadcast(keyed.sparkSession.createDataFrame(keyed.collect(), keyed.schema))
    hits = tokens.join(keyed, "key").select(url, "target", "rule", "verdict", "regex", "rank").where(F.expr("target rlike regex"))
    best = hits.groupBy(url).agg(F.max(F.struct("rank", "rule", "verdict")).alias("best"))
    best = best.select(F.col(url).alias("__url"), "best")
    all_ = with_parts(pages, url)
    out = all_.join(best, all_[url] == best["__url"], "left").drop("__url")
    listed = F.col("best.rank") >= 1_000_000
    return out.withColumn("rule", F.when(listed, F.col("best.rule"))).withColumn("pattern", F.when(~listed, F.col("best.rule"))).withColumn("verdict", F.coalesce("best.verdict", F.lit("allow"))).drop("best")


def _anywhere(i):
    return F.concat(F.lit("*"), i.cast("string"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, compile_rules(spark)).select("page_id", "host", "path", "rule", "verdict", "pattern")


OP6_SQL = r"""
WITH r AS (SELECT page_id, coalesce(regexp_extract(url, '^.*?://(.*)$', 1, 's'), '') AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules AS (SELECT * FROM (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                                ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')) v(rule, h, s, verdict)),
listed AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
           FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id),
words AS (SELECT w, '(?:^|[^a-zA-Z0-9])' || w || '(?:[^a-zA-Z0-9]|$)' AS x FROM (SELECT unnest(['cheap-pills', 'spam-farm', 'casino', 'free-download', 'adserver']) AS w)
          UNION ALL SELECT '||' || s || i || '.', '^([^/]*\.)?' || s || i || '\.'
                    FROM (SELECT unnest(['ads', 'banner', 'click', 'count', 'img-ad', 'pop', 'promo', 'spam', 'stat', 'track']) AS s), range(1, 26) r(i)
          UNION ALL VALUES ('||m.*.html|', '^([^/]*\.)?m\..*\.html$'), ('|track.*/pixel^', '^track\..*/pixel([^a-zA-Z0-9_.%-]|$)'),
                           ('/banner/*/img^', '/banner/.*/img([^a-zA-Z0-9_.%-]|$)'), ('*.exe|', '\.exe$'), ('||*.zip^', '\.zip([^a-zA-Z0-9_.%-]|$)')),
pats AS (SELECT page_id, arg_max(w, (length(w), w)) AS pattern FROM p JOIN words ON regexp_matches(host || path, x) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(listed.verdict, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM p LEFT JOIN listed USING (page_id) LEFT JOIN pats USING (page_id)
"""
