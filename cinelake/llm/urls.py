"""URL filter: domain rules first, then a weighted URL vocabulary found with an Aho-Corasick automaton.

Rules: the longest rule whose host is the url's host or a parent domain, and whose path starts the url's path,
decides; rules are looked up by the host and its parents, so their number does not matter. Vocabulary: terms count only between boundaries (no ASCII letter and no character from U+0080 on at either
side); one strict term, or ``soft_limit`` distinct soft terms, block the url.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule; a null url holds no term
and is allowed. Repeated rows are judged alike, an empty table gives an empty table, extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values: (verdict, host, path) of the domain rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# One of these is enough to reject.
STRICT = (
    "adult", "bestiality", "blowjob", "camgirl", "camgirls", "casino", "casinos", "cialis", "cumshot", "cumshots", "escort", "escorts", "gangbang",
    "hardcore", "hentai", "levitra", "milf", "milfs", "porn", "porno", "pornography", "pornos", "pornstar", "pornstars", "redtube", "sexcam",
    "sexcams", "shemale", "shemales", "swingers", "viagra", "warez", "xhamster", "xnxx", "xvideos", "xxx", "youporn",
)
# Several distinct ones together reject.
SOFT = (
    "amateur", "ass", "babe", "babes", "bet", "bets", "betting", "bingo", "bonus", "boobs", "cam", "cams", "cash", "cheap", "chat", "clickbait",
    "coupon", "coupons", "crack", "cracked", "credit", "date", "dating", "deal", "deals", "diet", "discount", "discounts", "download", "drugs",
    "erotic", "erotica", "farm", "fetish", "followers", "forex", "free", "gamble", "gambling", "girls", "hot", "jackpot", "keygen", "lingerie",
    "loan", "loans", "lottery", "mature", "naked", "nude", "nudes", "payday", "pharma", "pharmacy", "pills", "piracy", "poker", "promo", "replica",
    "replicas", "rolex", "roulette", "sale", "serial", "seo", "sex", "sexy", "singles", "slot", "slots", "spam", "spins", "steroids", "teen", "teens",
    "torrent", "torrents", "traffic", "vegas", "video", "videos", "wager", "webcam", "win", "winner", "xx",
)
SOFT_LIMIT = 2

SCHEMA = "host string, path string, rule string, verdict string, n_strict bigint, n_soft bigint"


def ascii_lower(s: str) -> str:
    return s.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first ``://`` up to / ? # or the end, then the path up to ? # or the end."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    stop = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:stop], rest[stop:]
    stop = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    return ascii_lower(host), rest[:stop]


@lru_cache(maxsize=8)
def rules_by_host(rules: tuple[tuple[str, str, str], ...]) -> dict[str, list[tuple[str, str]]]:
    """host -> (path, verdict) of its rules, the longest path first; of equal rules the first."""
    out: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        out.setdefault(host, []).append((path, verdict))
    return {host: sorted(own, key=lambda x: -len(x[0])) for host, own in out.items()}


def rule_for(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule, host and path together, that fits; of equally long ones the longer host's."""
    by_host, best, domain = rules_by_host(tuple(rules)), None, host
    while True:
        for start, verdict in by_host.get(domain, ()):
            if path.startswith(start):
                if best is None or len(domain) + len(start) > len(best[0]):
                    best = (domain + start, verdict)
                break
        _, dot, domain = domain.partition(".")
        if not dot:
            return best


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for term in soft:
        a.add_word(term, (term, False))
    for term in strict:
        a.add_word(term, (term, True))
    a.make_automaton()
    return a


def _inside(c: str) -> bool:
    return "a" <= c <= "z" or c >= "\x80"


def vocabulary_hits(text: str, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[int, int]:
    """Distinct strict and distinct soft terms that stand between boundaries in the lower-cased text."""
    if not strict and not soft:
        return 0, 0
    hard, mild, n = set(), set(), len(text)
    for end, (term, is_strict) in automaton(strict, soft).iter(text):
        first = end - len(term) + 1
        if (first == 0 or not _inside(text[first - 1])) and (end + 1 == n or not _inside(text[end + 1])):
            (hard if is_strict else mild).add(term)
    return len(hard), len(mild)


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per row: id, host, path, the deciding rule (or null), verdict, and the vocabulary counts."""
    src = pages.select(id_col, url_col)
    out = T.StructType([src.schema[id_col], *T._parse_datatype_string(SCHEMA).fields])
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for url in b.column(1).to_pylist():
                host, path = split_url(url)
                hard, mild = vocabulary_hits(ascii_lower(url or ""), strict, soft)
                found = rule_for(host, path, rules)
                verdict = found[1] if found else "block" if hard or mild >= soft_limit else "allow"
                rows.append((host, path, found[0] if found else None, verdict, hard, mild))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string()] * 4 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[f.name for f in out]
            )

    return src.mapInArrow(run, out)
