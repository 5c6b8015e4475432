"""URL filter: host and path rules, and a weighted vocabulary counted by an Aho-Corasick automaton.

One pass over a lower-cased URL (A-Z only) finds all terms of the vocabulary.  A term counts if no
ASCII letter or digit stands right before or after it.  One strict term, or ``most_soft`` different
soft ones, reject the URL.  Rules come first: a rule names a host, which stands for its subdomains
too, and a beginning of the path; of the rules that fit, the longest decides.

Null URLs and those without ``://`` have an empty host and path, so no rule fits; their text (null:
empty) is searched for terms all the same.  Every row gives one row, repeated rows included; an empty
table gives none.  Only ``page_id`` and ``url`` are read, whatever other columns exist.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow

#: One of these rejects.
STRICT = ("casino", "casinos", "porn", "porno", "xxx", "hardcore", "escort", "escorts", "camgirl", "camgirls", "viagra", "cialis", "warez",
          "keygen", "poker", "roulette", "jackpot", "phishing", "malware", "torrent", "torrents", "nsfw", "blackjack", "payday")
#: Several different ones reject.
SOFT = ("free", "bet", "bets", "betting", "win", "winner", "winners", "prize", "prizes", "bonus", "cheap", "discount", "deals", "sexy", "adult", "dating",
        "hot", "pills", "loan", "loans", "credit", "ads", "adserver", "banner", "banners", "track", "tracker", "tracking", "click", "clicks", "popup",
        "promo", "spam", "crack", "cracked", "download", "downloads", "slots", "lottery", "gambling")
MOST_SOFT = 2
#: (verdict, host, beginning of the path), as the query's contract fixes them.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict_terms int, soft_terms int"


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in (rest.find("?", end), rest.find("#", end)) if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:path_end]


class UrlFilter:
    """The rules and the vocabulary, both small enough for every task."""

    def __init__(self, strict=STRICT, soft=SOFT, rules=RULES, most_soft: int = MOST_SOFT):
        self.most_soft, self.by_host = most_soft, {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((len(host) + len(path), host + path, path, verdict))
        self.automaton = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for t in terms:
                self.automaton.add_word(t, (kind, t))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict."""
        found, at = (0, None, None, None), 0
        while at >= 0 and host:
            for r in self.by_host.get(host[at:], ()):
                if path.startswith(r[2]) and r[0] > found[0]:
                    found = r
            at = host.find(".", at) + 1 or -1
        return found[1], found[3]

    def hits(self, text: str) -> tuple[int, int]:
        """Different strict and soft terms, with boundaries on both sides."""
        found = {"strict": set(), "soft": set()}
        for end, (kind, term) in self.automaton.iter(text):
            start = end - len(term) + 1
            if (start and text[start - 1] in _WORD) or (end + 1 < len(text) and text[end + 1] in _WORD):
                continue
            found[kind].add(term)
        return len(found["strict"]), len(found["soft"])

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = parts(url)
        rule, verdict = self.rule(host, path)
        strict, soft = self.hits((url or "").translate(_LOWER))
        return host, path, rule, verdict or ("block" if strict or soft >= self.most_soft else "allow"), strict, soft


def judge(pages: DataFrame, strict=STRICT, soft=SOFT, rules=RULES, most_soft: int = MOST_SOFT) -> DataFrame:
    """Verdict on every URL of ``pages`` (page_id, url)."""

    def work(batches):
        f = UrlFilter(strict, soft, rules, most_soft)
        for batch in batches:
            found = list(zip(*map(f.judge, batch.column(1).to_pylist()))) or [[]] * 6
            kinds = [pa.string()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found, kinds)], names=["page_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms"])

    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")), work, SCHEMA)


def _oracle() -> str:
    """The same in SQL, with a regular expression for each term."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    has = lambda t: f"CAST(regexp_matches(t, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)"
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    verdicts = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in RULES)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, translate(coalesce(url, ''), '{up}', '{low}') AS t FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{up}', '{low}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path, t FROM u),
r AS (SELECT *, CASE {fits} END AS rule, {' + '.join(map(has, STRICT))} AS strict_terms, {' + '.join(map(has, SOFT))} AS soft_terms FROM p)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN strict_terms > 0 OR soft_terms >= {MOST_SOFT} THEN 'block' ELSE 'allow' END END AS verdict,
       CAST(strict_terms AS INT) AS strict_terms, CAST(soft_terms AS INT) AS soft_terms FROM r"""


ORACLE = _oracle()
