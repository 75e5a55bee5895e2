"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

A url's host is what follows its first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A-Z as a-z; its path is what follows up to ``?``, ``#`` or the end. A
rule names a host and the beginning of a path; it fits its host and all
subdomains, and of the rules that fit, the one with the longest text (host and
path; of equally long ones that of the longer host) decides.

A url without a rule is judged by the vocabulary: one automaton finds the
strict and the soft terms in the whole url (A-Z as a-z, nothing decoded) in one
pass. A match counts if no letter or digit of ASCII and no character beyond
ASCII touches it. A strict term weighs ``SOFT_HITS``, a soft one 1, each
counted once a url; at ``SOFT_HITS`` the url is blocked.

Rules and vocabulary are parameters of the job, sent to the tasks with the
function; ``MOST_ENTRIES`` of each is the bound, and longer lists are refused. Every row is judged in
its own task, without a shuffle.

Defined results: a null url, or one without ``://``, has an empty host and
path, which no rule fits (a null one has no terms either and is allowed); a
host with a port or user is taken as written, so that only a rule for this very
text, or for what follows one of its dots, fits; a url without a path fits no rule with a path. Rows
that repeat, or whose page_id is null, each have their result; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table

# --- Fixed values: the rules and the vocabulary of the query ---
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
STRICT = ("adult", "bookmaker", "casino", "escorts", "hentai", "keygen", "malware", "milf", "nude", "nudes", "phishing", "porn", "porno", "pornstar", "sportsbook", "viagra", "warez", "webcams", "xxx")
SOFT = ("ads", "adserver", "bet", "bets", "betting", "bonus", "cams", "cheap", "clicks", "crack", "dating", "farm", "free", "gamble", "gambling", "hot", "jackpot", "loan", "loans", "lottery", "money", "payday",
        "pills", "poker", "popup", "promo", "roulette", "sexy", "slots", "spam", "tits", "torrent", "track", "tracker", "win", "winner")
# --- end of fixed values ---
SOFT_HITS = 2
MOST_ENTRIES = 100_000
JUDGED = "page_id long, host string, path string, rule string, verdict string, strict_terms int, soft_terms int"

_LOWER = {k: k + 32 for k in range(65, 91)}
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_and_path(url: str | None) -> tuple[str, str]:
    found = _PARTS.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def longest_rule(rules: Iterable[tuple[str, str]]) -> Callable[[str, str], tuple[str | None, str | None]]:
    """A function from (host, path) to (action, rule) of the rule that decides, or (None, None)."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for action, rule in rules:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host, []).append((slash + path, action, rule))
    for own in by_host.values():
        own.sort(key=lambda x: -len(x[0]))

    def decide(host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        while host:  # from the whole host to its last label
            for begin, action, rule in by_host.get(host, ()):
                if path.startswith(begin):
                    if best[1] is None or len(rule) > len(best[1]):
                        best = (action, rule)
                    break
            host = host.partition(".")[2]
        return best

    return decide


@cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    """Built once a worker. A term of both lists is strict."""
    out = ahocorasick.Automaton()
    for heavy, terms in ((False, soft), (True, strict)):
        for term in terms:
            out.add_word(term.translate(_LOWER), (term, heavy))
    out.make_automaton()
    return out


def terms_of(url: str | None, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[set[str], set[str]]:
    """The distinct strict and soft terms of a url."""
    found: tuple[set[str], set[str]] = (set(), set())
    if not url or not (strict or soft):
        return found
    text = url.translate(_LOWER)
    inner = lambda k: 0 <= k < len(text) and (text[k] in _INNER or text[k] >= "\x80")
    for last, (term, heavy) in _automaton(strict, soft).iter(text):
        if not inner(last + 1) and not inner(last - len(term)):
            found[0 if heavy else 1].add(term)
    return found


def judged(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): host, path, the rule that decides or null, the verdict and the distinct terms."""
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)
    for name, given in (("rules", rules), ("strict terms", strict), ("soft terms", soft)):
        if len(given) > MOST_ENTRIES:
            raise ValueError(f"{len(given)} {name}: at most {MOST_ENTRIES} are sent to the tasks")
    if any(action not in ("allow", "block") for action, _ in rules) or not all([*strict, *soft]):
        raise ValueError("a rule allows or blocks, and no term is empty")
    decide = longest_rule(rules)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url in batch.column("url").to_pylist():
            host, path = host_and_path(url)
            action, rule = decide(host, path)
            heavy, light = terms_of(url, strict, soft)
            weight = soft_hits * len(heavy) + len(light)
            rows.append((host, path, rule, action or ("block" if weight >= soft_hits else "allow"), len(heavy), len(light)))
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        kinds = [pa.string()] * 4 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[x.split()[0] for x in JUDGED.split(", ")])

    return in_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")), each, JUDGED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def _sql() -> str:
    outside = r"[^a-z0-9\x{80}-\x{10FFFF}]"
    count = lambda terms: " + ".join(rf"CAST(regexp_matches(lower_url, '(?:^|{outside}){t}(?:$|{outside})') AS INT)" for t in terms)
    rows = ", ".join(f"('{a}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for a, r in RULES)
    return rf"""
WITH rules(action, rule, rule_host, rule_path) AS (VALUES {rows}),
u AS (SELECT row_number() OVER () AS k, page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_url,
             translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT k, rule, action FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rule) DESC, length(rule_host) DESC) = 1),
t AS (SELECT *, {count(STRICT)} AS strict_terms, {count(SOFT)} AS soft_terms FROM u)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN {SOFT_HITS} * strict_terms + soft_terms >= {SOFT_HITS} THEN 'block' ELSE 'allow' END) AS verdict, strict_terms, soft_terms
FROM t LEFT JOIN f USING (k)
"""


SQL = _sql()
