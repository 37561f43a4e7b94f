"""URL filter: host and path rules over a weighted vocabulary.

An Aho-Corasick automaton finds the vocabulary's terms in the lower-cased URL;
an occurrence counts if no ASCII letter or digit stands next to it.  The
weights of the distinct terms found are added, and a URL is rejected at
``LIMIT``: one strict term, or several soft ones.  A rule for the host or a
domain above it and the path's beginning decides before the vocabulary does;
the longest one wins, and of equal ones the one that blocks.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule, and is judged by its terms (null: none, allowed).  Other columns
and repeated rows pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import lean

LIMIT = 1.0
STRICT, SOFT = 1.0, 0.5

#: Terms by weight; lower case.
STRICT_TERMS = ["adult", "casino", "escort", "porn", "spam", "viagra", "warez", "xxx"]
SOFT_TERMS = ["ads", "bet", "bets", "bonus", "cheap", "click", "discount", "free", "loan", "pill",
              "pills", "poker", "promo", "track", "win"]
VOCABULARY = {t: STRICT for t in STRICT_TERMS} | {t: SOFT for t in SOFT_TERMS}

_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(_UPPER, _LOWER)


def _automaton(vocabulary: Mapping[str, float]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def _weight(automaton, url: str) -> float:
    low = url.translate(_ASCII_LOWER)
    hits = {}
    for end, (term, weight) in automaton.iter(low):
        begin = end - len(term)  # the character before the term
        if (begin < 0 or low[begin] not in _WORD) and (
                end + 1 == len(low) or low[end + 1] not in _WORD):
            hits[term] = weight
    return sum(hits.values())


def _by_host(rules: Sequence[tuple[str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """For each host (path, rule, verdict), best first."""
    out: dict[str, list] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        out.setdefault(host, []).append((slash + path, rule, verdict))
    for found in out.values():
        found.sort(key=lambda r: (-len(r[1]), r[2] != "block"))
    return out


def _best_rule(by_host: dict, host: str, path: str) -> tuple[str, str] | None:
    best, at = None, 0
    while host and at >= 0:
        for prefix, rule, verdict in by_host.get(host[at:], ()):
            if path.startswith(prefix):
                if best is None or (len(rule), verdict == "block") > (len(best[0]), best[1] == "block"):
                    best = (rule, verdict)
                break
        at = host.find(".", at) + 1 or -1
    return best


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]],
               vocabulary: Mapping[str, float] = VOCABULARY, limit: float = LIMIT) -> DataFrame:
    """``page_id, host, path, rule, weight, verdict`` of every row.  ``rules``
    are (allow or block, ``host/path``); rules and vocabulary are parameters
    sent to every task."""
    place = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.translate(F.coalesce(F.regexp_extract("url", place, 1), F.lit("")), _UPPER, _LOWER)
        .alias("host"),
        F.coalesce(F.regexp_extract("url", place, 2), F.lit("")).alias("path"))
    by_host, terms = _by_host(rules), dict(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(terms) if terms else None
        for batch in batches:
            page, url, host, path = batch.columns
            rule, weight, verdict = [], [], []
            for u, h, p in zip(url.to_pylist(), host.to_pylist(), path.to_pylist()):
                best = _best_rule(by_host, h, p)
                weight.append(_weight(automaton, u) if u and automaton else 0.0)
                rule.append(best[0] if best else None)
                verdict.append(best[1] if best else "block" if weight[-1] >= limit else "allow")
            yield pa.RecordBatch.from_arrays(
                [page, host, path, pa.array(rule, pa.string()), pa.array(weight, pa.float64()),
                 pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "weight", "verdict"])

    return urls.mapInArrow(
        lean(work), "page_id long, host string, path string, rule string, weight double, verdict string")
