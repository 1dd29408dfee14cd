"""Secret scans with a trigram inverted index.

Each rule is a regular expression.  From its syntax tree a Boolean query over
trigrams is derived that every matching text satisfies.  Every Arrow batch of
texts is one index segment: a posting list per trigram that some rule asks for
(sorted document numbers).  A rule's candidates are the intersections and
unions of its postings; only they meet the regular expression.  A rule without
mandatory trigrams scans every text.

Scale: a narrow map with bounded segments, no shuffle, no state between
segments; a lost executor costs its own segments only.  Postings are
kept for the rules' trigrams alone, so an index is never larger than
(trigrams of all rules) x (texts of a segment).

The index is over bytes with A-Z lower-cased; so are the queries, which keeps them
true for rules in either case.
"""

from __future__ import annotations

import re
from itertools import product
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts, pick


class Rule(NamedTuple):
    kind: str
    pattern: str
    ignore_case: bool = False
    #: Only matches whose `group` has at least this many characters count.
    group: int = 0
    least: int = 1


#: The base rules: fixed values, in the order in which equal starts are listed.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 18),
    Rule("hex", r"[0-9a-f]+", False, 0, 16),
]
_KEY = r"(?:[A-Z]+ ){0,3}PRIVATE KEY-----"
#: Further public token formats.  A key goes to its END line whatever it holds but the BEGIN line of another key.
MORE = [
    Rule("private_key", f"-----BEGIN {_KEY}(?:(?:[^-]+|-(?!----(?:BEGIN|END) {_KEY}))*+-----END {_KEY})?"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]+", False, 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", False, 0, 20),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]+", False, 0, 39),
    Rule("pay_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]+", False, 0, 24),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\s/:@]+:[^\s/:@]{3,}@"),
]
RULES = BASE + MORE
REDACTED = "[REDACTED]"

#: Strings that one stretch of a pattern may stand for before it is cut.
MAX_STRINGS = 24

# A query is True (every text), a trigram of bytes, or ("and" | "or", queries).
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _all(parts: list) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _trigrams(strings: set[bytes]) -> object:
    """What a text holds that holds one of the strings."""
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every text matching `pattern` satisfies."""
    parser, ops = re._parser, re._constants

    def lone(op, arg) -> set[bytes] | None:
        """The few strings that a node stands for, or None."""
        if op is ops.LITERAL:
            return {chr(arg).encode().translate(_LOWER)}
        if op is ops.IN and all(o in (ops.LITERAL, ops.RANGE) for o, _ in arg):
            codes = {c for o, a in arg for c in ([a] if o is ops.LITERAL else range(a[0], min(a[1], a[0] + MAX_STRINGS) + 1))}
            return {chr(c).encode().translate(_LOWER) for c in codes} if len(codes) <= MAX_STRINGS else None
        if op is ops.SUBPATTERN:
            return joined(arg[-1])
        if op is ops.BRANCH:
            found = [joined(x) for x in arg[1]]
            return None if None in found else set().union(*found)
        if op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[1] <= 3 and (one := joined(arg[2])) is not None:
            found: set[bytes] = set()
            for n in range(arg[0], arg[1] + 1):
                if len(one) ** n > MAX_STRINGS:
                    return None
                found |= {b"".join(p) for p in product(one, repeat=n)}
            return found
        return {b""} if op is ops.AT else None

    def joined(nodes) -> set[bytes] | None:
        strings = {b""}
        for node in nodes:
            own = lone(*node)
            if own is None or len(own) * len(strings) > MAX_STRINGS:
                return None
            strings = {a + b for a in strings for b in own}
        return strings

    def required(nodes) -> object:
        parts, run = [], {b""}
        for op, arg in nodes:
            own = lone(op, arg)
            if own is not None and len(own) * len(run) <= MAX_STRINGS:
                run = {a + b for a in run for b in own}
                continue
            parts.append(_trigrams(run))
            run = {b""}
            if own is not None and len(own) <= MAX_STRINGS:
                run = own
            elif op is ops.SUBPATTERN:
                parts.append(required(arg[-1]))
            elif op is ops.BRANCH:
                parts.append(_any([required(x) for x in arg[1]]))
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0] >= 1:
                parts.append(required(arg[2]))
        return _all([*parts, _trigrams(run)])

    return required(parser.parse(pattern))


def needed(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(needed, query[1]))


class Segment:
    """The inverted index of one batch of texts."""

    def __init__(self, texts: list[bytes], numbers: np.ndarray, trigrams: list[bytes]):
        """`numbers`: by trigram code, 1 + the trigram's place in `trigrams`, or 0."""
        self.size = len(texts)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        codes = np.frombuffer(b"\n".join(texts).translate(_LOWER), dtype=np.uint8).astype(np.int32)
        self.postings: dict[bytes, np.ndarray] = {}
        if len(codes) < 3:
            return
        found = numbers[(codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]]
        at = np.flatnonzero(found)
        pairs = np.unique(found[at].astype(np.int64) * self.size + np.searchsorted(starts, at, "right") - 1)
        kinds, docs = np.divmod(pairs, self.size)
        cuts = np.searchsorted(kinds, np.arange(1, len(trigrams) + 2))
        self.postings = {t: docs[cuts[i]:cuts[i + 1]] for i, t in enumerate(trigrams)}

    def candidates(self, query: object) -> np.ndarray:
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings.get(query, np.empty(0, np.int64))
        found = self.candidates(query[1][0])
        for part in query[1][1:]:
            if query[0] == "and" and not len(found):
                break
            found = (np.intersect1d if query[0] == "and" else np.union1d)(found, self.candidates(part))
        return found


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.ignore_case else 0))) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = sorted(set().union(*map(needed, self.queries)))
        self.numbers = np.zeros(1 << 24, dtype=np.int16)
        for i, t in enumerate(self.trigrams):
            self.numbers[(t[0] << 16) | (t[1] << 8) | t[2]] = i + 1

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """For each text its spans (kind, start, end) by start, then by the rules' order."""
        segment = Segment([t.encode("utf-8", "replace") for t in texts], self.numbers, self.trigrams)
        found: list[list] = [[] for _ in texts]
        for n, ((rule, pattern), query) in enumerate(zip(self.rules, self.queries)):
            for i in segment.candidates(query):
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), n, m.end()))
        return [[(self.rules[n][0].kind, a, b) for a, n, b in sorted(x)] for x in found]


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = REDACTED) -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    if not spans:
        return text
    parts, at = [], 0
    runs: list[list[int]] = []
    for _, a, b in spans:
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    for a, b in runs:
        parts += [text[at:a], mark]
        at = b
    return "".join([*parts, text[at:]])


#: `[0-9a-f]+` of at least 16 characters is the same set of runs as this, found without visiting short runs.
_FAST_HEX = r"[0-9a-f]{16,}"


def secret_spans(docs: DataFrame, rules: list[Rule] | None = None, key: str = "doc_id", text: str = "text",
                 carry: tuple[str, ...] = (), with_text: bool = True) -> DataFrame:
    """One row per row of `docs`: key, `carry`, spans, redacted_text.

    spans: array<struct<kind string, start int, end int>>, offsets in code
    points, end exclusive, by start, then in the rules' order.  Null texts have
    no spans and a null redacted text.  Repeated rows and null keys are kept; an
    empty table gives an empty result; other columns are not looked at.
    """
    rules = [r._replace(pattern=_FAST_HEX) if r == BASE[2] else r for r in (RULES if rules is None else rules)]

    def make():
        scanner = Scanner(rules)

        def run(texts: list[str | None]) -> list[list]:
            found = scanner.scan([t or "" for t in texts])
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found]
            return [spans, [None if t is None else redact(t, x) for t, x in zip(texts, found)]][: 1 + with_text]
        return run

    out = "spans array<struct<kind:string,start:int,end:int>>" + ", redacted_text string" * with_text
    return map_texts(pick(docs, key, *carry, text), (key, *carry), text, out, make)


def joined_spans(spans: str, kinds: list[str] | None = None) -> Column:
    """kind:start:end of the spans (of some kinds), comma-joined."""
    chosen = F.col(spans)
    if kinds is not None:
        chosen = F.filter(chosen, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
