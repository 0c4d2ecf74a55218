"""Secret scan: fixed patterns, and windows of high Shannon entropy over candidate strings.

A candidate is a run of at least WINDOW characters of the base64 alphabet, cut after each '=' (a name ends there, or
a padded value). Each character class (hex, alnum, base64) has its own entropy limit, and a window slides over
every longest run of a class inside the candidate; the counts of its characters, and the sum of c*log2(c) that
gives the entropy, change by one character out and one in. Overlapping windows of a class above its limit form
one span. The allow-list suppresses runs that are known to be harmless: words and numbers, UUIDs, parts of urls
but for their userinfo, and any string or pattern that the caller adds. Letters are words if they have one case, or
if small letters come in runs of at least two, but for a short word after a longer one or a sign, as in NumberOfRows.

Defined cases: a null text counts as empty and has no spans; offsets count code points, ends are exclusive; an
entropy span inside a span of a fixed pattern, or of another class, is not told twice; a text is scanned whole and in time linear in
its length; repeated rows are scanned one by one; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame

from winback.llm.arrow import map_texts

Span = tuple[str, int, int]

#: fixed patterns and the order of their kinds
ASSIGN = re.compile(
    r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
BASE_KINDS = ("assign", "access", "hex")
ENTROPY_KINDS = ("entropy_hex", "entropy_alnum", "entropy_base64")
KIND_ORDER = {kind: at for at, kind in enumerate((*BASE_KINDS, *ENTROPY_KINDS))}

WINDOW = 20
#: bits a character; a window of 20 has 4.3 at most, 4 if it is hex
LIMITS = {"entropy_hex": 3.0, "entropy_alnum": 3.6, "entropy_base64": 3.8}
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: a part of a candidate: a name, or a value with its padding
PART = re.compile(r"[^=]+=*")
RUNS = tuple(
    (kind, re.compile(rf"{chars}{{{WINDOW},}}"))
    for kind, chars in (("entropy_hex", "[0-9a-f]"), ("entropy_hex", "[0-9A-F]"), ("entropy_alnum", "[A-Za-z0-9]"), ("entropy_base64", "[A-Za-z0-9+/_=-]"))
)
UUID = r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"
ONE_CASE_OR_NUMBERS = r"[A-Z+/_=-]+|[a-z+/_=-]+|[0-9+/_=-]+"
WORDS = r"(?:[A-Z]*+[a-z]{2,}+(?:[A-Z][a-z](?![a-z]))?+|[A-Z]++(?![a-z])|[+/_=-]++(?:[A-Z][a-z](?![a-z]))?+)++"
#: what follows the scheme of a url
URL_REST = re.compile(r"""[^\s"'`<>,;|\\^(){}\[\]]*""")
AUTHORITY = re.compile(r"[^/?#@]*")
SPANS_SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping within a kind."""
    found = [
        ("assign", match.start(), match.end())
        for match in ASSIGN.finditer(text)
        if match.end(1) - match.start(1) >= LEAST_ASSIGNED
    ]
    found += [("access", match.start(), match.end()) for match in ACCESS.finditer(text)]
    found += [("hex", match.start(), match.end()) for match in HEX.finditer(text)]
    return found


def high_windows(text: str, limit: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Unions of the windows whose entropy is at least ``limit``."""
    weight = [0.0] + [count * math.log2(count) for count in range(1, window + 1)]
    most = window * (math.log2(window) - limit) + 1e-9  # entropy >= limit means sum of c*log2(c) <= this
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for at, char in enumerate(text):
        count = counts.get(char, 0)
        if at >= window:
            old = text[at - window]
            if old != char:
                gone = counts[old]
                total += weight[gone - 1] - weight[gone]
                counts[old] = gone - 1
                total += weight[count + 1] - weight[count]
                counts[char] = count + 1
        else:
            total += weight[count + 1] - weight[count]
            counts[char] = count + 1
        if at >= window - 1 and total <= most:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


@dataclass(frozen=True)
class AllowList:
    """What is never a secret: exact strings, and patterns that a whole candidate, a part or a run of one class must match."""

    strings: frozenset[str] = frozenset()
    patterns: Sequence[str] = field(default=(UUID, ONE_CASE_OR_NUMBERS, WORDS))

    def allows(self, text: str) -> bool:
        return text in self.strings or any(re.fullmatch(pattern, text) for pattern in self.patterns)


def url_spans(text: str) -> list[tuple[int, int]]:
    """Parts of urls after their scheme's colon, in order; names and passwords before the host are not among them."""
    found, at = [], text.find("://")
    while at >= 0:
        start, end = at + 3, URL_REST.match(text, at + 3).end()
        if at and text[at - 1].isalnum():
            stop = AUTHORITY.match(text, start, end).end()
            port = text[start:stop].partition(":")[2]
            # a password may hold slashes, a port is a number
            host = stop + 1 if text[stop : min(stop + 1, end)] == "@" else text.rfind("@", start, end) + 1 if port and not port.isdigit() else 0
            found.append((host or at + 1, end))
        at = text.find("://", end)
    return found


def _within(spans: Sequence[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the sorted, disjoint spans holds [start, end)."""
    at = bisect_right(spans, start, key=lambda span: span[0])
    return at > 0 and end <= spans[at - 1][1]


def entropy_spans(text: str, allowed: AllowList) -> list[Span]:
    found, urls = [], None
    for match in CANDIDATE.finditer(text):
        urls = url_spans(text) if urls is None else urls
        if allowed.allows(match[0]):
            continue
        for part in PART.finditer(text, match.start(), match.end()):
            if part.end() - part.start() < WINDOW or _within(urls, *part.span()) or allowed.allows(part[0]):
                continue
            told: list[tuple[str, list[tuple[int, int]]]] = []  # smaller classes first
            for kind, run_of in RUNS:
                spans = []
                for run in run_of.finditer(text, *part.span()):
                    if not allowed.allows(run[0]):
                        spans += [(run.start() + a, run.start() + b) for a, b in high_windows(run[0], LIMITS[kind])]
                told.append((kind, spans))
            sets = [set(spans) for _, spans in told]
            for at, (kind, spans) in enumerate(told):
                others = [(after > at, other, sets[after]) for after, (_, other) in enumerate(told) if after != at]
                # of equal spans that of the smaller class is told
                found += [(kind, *span) for span in spans if not any(_within(other, *span) and not (after and span in same) for after, other, same in others)]
    return found


def find_spans(text: str, allowed: AllowList) -> list[Span]:
    """All spans by start, then kind."""
    base = base_spans(text)
    # by start, with the farthest end so far: base spans of different kinds may overlap
    ordered = sorted((start, end) for _, start, end in base)
    reach = list(accumulate((end for _, end in ordered), max))

    def inside(start: int, end: int) -> bool:
        at = bisect_right(ordered, start, key=lambda span: span[0])
        return at > 0 and end <= reach[at - 1]

    more = [span for span in entropy_spans(text, allowed) if not inside(*span[1:])]
    return sorted(base + more, key=lambda span: (span[1], KIND_ORDER[span[0]], span[2]))


def find_secrets(docs: DataFrame, allowed: AllowList | None = None) -> DataFrame:
    """doc_id and spans (kind, start, end) of every document."""
    allowed = allowed or AllowList()

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        spans = [[dict(zip(("kind", "start", "end"), span, strict=True)) for span in find_spans(text, allowed)] for text in texts]
        return {"doc_id": doc_ids, "spans": spans}

    return map_texts(docs, SPANS_SCHEMA, work)
