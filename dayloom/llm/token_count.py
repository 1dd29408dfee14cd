"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as one symbol per byte.  Its symbols form a doubly linked list,
all adjacent pairs that have a merge rank lie in a heap, and the lowest rank
(leftmost first) is popped and merged until no ranked pair is left.  Each merge
removes one symbol, so the count is initial symbols minus merges; no token
identifiers are made.

Scale: a narrow map over the texts, no shuffle.  Counts of white-space-separated
pieces are kept in a cache of bounded size for the length of a task, since a
piece's count does not depend on its neighbours.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import regex
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, pick

#: Default of `max_tokens`: documents above it are flagged.
MAX_TOKENS = 2048
#: Pieces and words whose counts a task keeps (some 100 MB for both), and the longest piece that is kept.
CACHE_PIECES, CACHE_CHARS = 400_000, 60

# Python's split() also cuts at these four; the vocabulary's white space does not hold them.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others get the
    characters from U+0100 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts tokens of whole texts with the vocabulary file's own settings."""

    def __init__(self, spec: dict):
        model = spec["model"]
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.alphabet = byte_alphabet()
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_hint = special
        self.cache: dict[str, int] = {}
        self.words_seen: dict[str, int] = {}

    def merges(self, symbols: list[str]) -> int:
        """How many merges the symbols of one word undergo."""
        ranks, n = self.ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [rank * n + i for i in range(n - 1)
                if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        done = 0
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            # an entry is stale if its left symbol is gone or either side has grown
            if j >= n or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            after[i] = k = after[j]
            done += 1
            if k < n:
                before[k] = i
                if (new := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, new * n + i)
            if (h := before[i]) >= 0 and (new := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, new * n + h)
        return done

    def word(self, word: str) -> int:
        found = self.words_seen.get(word)
        if found is None:
            alphabet = self.alphabet
            symbols = [alphabet[b] for b in word.encode("utf-8", "replace")]
            symbols[-1] += self.suffix
            found = len(symbols) - (self.merges(symbols) if len(symbols) > 1 else 0)
            if len(word) <= CACHE_CHARS:
                if len(self.words_seen) >= CACHE_PIECES:
                    self.words_seen.clear()
                self.words_seen[word] = found
        return found

    def plain(self, piece: str) -> int:
        """A piece without white space and special strings, in the file's normal form."""
        normal = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        return sum(map(self.word, self.words.findall(normal)))

    def piece(self, piece: str) -> int:
        found = self.cache.get(piece)
        if found is None:
            found = 0
            if self.special and any(s in piece for s in self.special_hint):
                found = len(self.special.findall(piece))
                found += sum(self.plain(p) for p in self.special.split(piece) if p)
            else:
                found = self.plain(piece)
            if len(piece) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_PIECES:
                    self.cache.clear()
                self.cache[piece] = found
        return found

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = text.split() if not _SEPARATORS.search(text) else [p for p in _WHITE.split(text) if p]
        get, total = self.cache.get, 0
        for p in pieces:
            n = get(p)
            total += self.piece(p) if n is None else n
        return total


def token_counts(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens.  Whole texts of any length
    are counted; repeated rows and null keys are kept; an empty table gives an
    empty result; columns other than key and text are not looked at.  The
    vocabulary is read on the driver and sent with the task (under 2 MB).
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    spec = {k: spec[k] for k in ("pre_tokenizer", "added_tokens")} | {
        "model": {k: spec["model"].get(k) for k in ("merges", "end_of_word_suffix")}}

    def make():
        counter = MergeCounter(spec)
        return lambda texts: [[counter.text(t) for t in texts]]

    rows = pick(docs, key, text).withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    return (map_texts(rows, (key, "n_bytes"), text, "n_tokens long", make)
            .withColumn("over_limit", F.col("n_tokens") > max_tokens))
