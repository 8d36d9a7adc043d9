"""URL filter: site rules, then a weighted vocabulary found by an Aho-Corasick automaton.

One automaton of all terms runs over the lower-cased URL; an occurrence counts if no letter
or digit (ASCII) stands next to it. One strict term rejects a URL, as do two or more
different soft terms whose weights add up to SOFT_LIMIT: 2 for words of the trade itself, 1
for words that only go with them. Rules (host and its subdomains, beginning of the path)
come first; of those that fit, the longest decides. The automaton is built once in each task
from the term lists, which are parameters; URLs are never shuffled and the pages' other
columns never read.

Null URL, or none with "://": host and path are empty; a null URL has no terms. Every row
is judged by itself, repeated ones too; an empty table gives an empty result. A long URL costs
its length; other columns of the table, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgene.llm import store

# The terms of the vocabulary.
STRICT = (
    "adult", "bdsm", "bestiality", "blowjob", "bondage", "boobs", "brazzers", "bukkake", "camgirl", "camgirls", "camsex", "chaturbate", "creampie", "cumshot", "deepthroat", "erotic", "erotica", "escort",
    "escorts", "fetish", "gangbang", "handjob", "hardcore", "hentai", "incest", "jizz", "milf", "milfs", "nsfw", "onlyfans", "orgy", "pornhub", "porn", "porno", "pornstar", "redtube", "sex", "sexcam",
    "sexcams", "sexshop", "sextape", "shemale", "stripper", "striptease", "threesome", "tits", "upskirt", "voyeur", "xhamster", "xnxx", "xvideos", "xxx", "youporn",
)
SOFT = {
    **dict.fromkeys(
        (
            "baccarat", "bet", "bets", "betting", "bingo", "blackjack", "bookmaker", "cam", "casino", "casinos", "cialis", "counterfeit", "crack", "cracked", "dating", "forex", "gambling", "girls", "hookup", "hookups", "jackpot",
            "keygen", "levitra", "loan", "loans", "lottery", "nude", "nudes", "payday", "pharmacy", "pills", "poker", "replica", "roulette", "serials", "sexy", "singles", "slot", "slots", "sportsbook", "steroids",
            "torrent", "torrents", "viagra", "warez", "webcam", "webcams", "xanax",
        ),
        2,
    ),
    **dict.fromkeys(
        (
            "amateur", "best", "bonus", "buy", "cash", "cheap", "chat", "clicks", "coupon", "coupons", "credit", "crypto", "deal", "deals", "discount", "download", "earn", "fast", "free", "hot", "instant", "live",
            "lucky", "meet", "money", "offer", "offers", "online", "prescription", "prize", "prizes", "promo", "rich", "sale", "spins", "stream", "teen", "teens", "trial", "vip", "wholesale", "win", "winner", "young",
        ),
        1,
    ),
}
SOFT_LIMIT = 3
#: verdict, host, beginning of the path
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hits(batches: Iterator[pa.RecordBatch], strict, soft) -> Iterator[pa.RecordBatch]:
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term in {*strict, *soft}:
        machine.add_word(term, (len(term), term))
    machine.make_automaton()
    strict, weights, fold, word = frozenset(strict), soft, str.maketrans(_UPPER, _LOWER), frozenset(_LOWER + "0123456789")
    for b in batches:
        counts = []
        for url in b.column(1).to_pylist():
            url, found = (url or "").translate(fold), set()
            for end, (n, term) in machine.iter(url):
                if (end < n or url[end - n] not in word) and (end + 1 == len(url) or url[end + 1] not in word):
                    found.add(term)
            counts.append((len(found & strict), len(found - strict), sum(weights[t] for t in found - strict)))
        new = [pa.array(c, pa.int32()) for c in (zip(*counts, strict=True) if counts else ((), (), ()))]
        yield pa.RecordBatch.from_arrays([*b.columns, *new], names=["page_id", "url", "n_strict", "n_soft", "soft_weight"])


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def judge(pages: DataFrame, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict and n_soft (different terms) and soft_weight of every row. soft: terms and weights; a strict one isn't soft, too."""
    store.import_path(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    found = pages.select("page_id", "url").mapInArrow(lambda it: _hits(it, strict, soft), f"page_id {kind}, url string, n_strict int, n_soft int, soft_weight int")
    host, path = host_and_path(F.col("url"))
    found = found.select("page_id", host.alias("host"), path.alias("path"), "n_strict", "n_soft", "soft_weight")
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    terms = F.when((F.col("n_strict") > 0) | ((F.col("n_soft") >= 2) & (F.col("soft_weight") >= soft_limit)), "block").otherwise("allow")
    return found.select("page_id", "host", "path", (F.lit(None).cast("string") if rule is None else rule).alias("rule"), (terms if verdict is None else verdict.otherwise(terms)).alias("verdict"), "n_strict", "n_soft", "soft_weight")


def sql(strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT, rules=RULES) -> str:
    """The same in DuckDB's SQL over the table pages."""
    hit = lambda t, n=1: f"(CASE WHEN contains(low, '{t}') AND regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN {n} ELSE 0 END)"
    order = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in order)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in order)
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
WITH t AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(regexp_extract(coalesce(url, ''), '{pattern}', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{pattern}', 2) AS path
  FROM pages),
u AS (
  SELECT page_id, host, path, CAST({" + ".join(map(hit, strict))} AS INTEGER) AS n_strict, CAST({" + ".join(map(hit, soft))} AS INTEGER) AS n_soft, CAST({" + ".join(hit(t, n) for t, n in soft.items())} AS INTEGER) AS soft_weight
  FROM t)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN n_strict > 0 OR n_soft >= 2 AND soft_weight >= {soft_limit} THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft, soft_weight
FROM u"""
