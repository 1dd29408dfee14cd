"""Quality rules, line first: bad lines go, then documents that lost too much.

Every line that holds a word is judged by itself:

* punctuation: symbol litter (`[#*$%&|<>]`, more than one for ten other word
  characters), shouting (half of the words end in `!!`, `??` and the like), or
  `LONG_LINE` words and more without a single punctuation mark;
* navigation: menus of short entries parted by `|`, `>`, bullets and the like, and
  short lines that start with a menu command;
* boilerplate: short lines with a stock phrase of page furniture, and lines of `STUTTER`
  words and more of which over half repeat the word before them.

Failing lines are removed; a document is rejected if more than `MAX_LOST` of its
words went with them.  Documents that fail the base rules (under 20 words, or over 30 % of
the words in repeated 8-word windows) are rejected whatever their lines say.

Scale: a narrow map, one pass over the text, no shuffle.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts, pick

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
#: Percent of the words in repeated windows that a document may have.
MAX_REPEATED = 30
#: Percent of the words that a document may lose with its bad lines.
MAX_LOST = 50
#: Percent of a line's word characters that may be symbols.
MAX_LINE_SYMBOLS = 10
LONG_LINE = 40
#: Words that part the entries of a menu: fixed values.
SEPARATORS = [b"|", b">", b"/", b"::", "·".encode(), "•".encode(), "»".encode(), "›".encode()]
#: Starts of menu lines, up to `MENU_WORDS` words long: fixed values.
MENU = ["home", "menu", "log in", "login", "sign in", "sign up", "skip to content", "next page", "previous page",
        "back to top", "site map", "sitemap"]
MENU_WORDS = 6
#: Phrases of page furniture, in lines of up to `STOCK_WORDS` words: fixed values.
STOCK = ["all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
         "uses cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter", "click here",
         "follow us on", "share this page", "powered by"]
STOCK_WORDS = 20
STUTTER = 8

_SYMBOL = regex.compile("[" + SYMBOLS + "]")
_SHOUT = regex.compile(rb"[!?]{2,}(?=[ \t-\r]|\Z)")
_MARK = regex.compile(r"\p{P}")
_MENU = regex.compile(r"(?:" + "|".join(MENU) + r")(?![0-9a-z])")
_STOCK = regex.compile("|".join(STOCK))
_WHITE = str.maketrans("", "", " \t\n\r\x0b\x0c")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def line_fault(line: str, words: list[bytes]) -> str | None:
    """The rule that a line with these words fails, or None."""
    n = len(words)
    symbols = len(_SYMBOL.findall(line))
    if symbols and symbols * 100 > MAX_LINE_SYMBOLS * len(line.translate(_WHITE)) and not sum(map(words.count, SEPARATORS)) * 4 >= n:
        return "punctuation"
    if ("!" in line or "?" in line) and 2 * len(_SHOUT.findall(line.encode("utf-8", "replace"))) >= n:
        return "punctuation"
    if n >= LONG_LINE and not _MARK.search(line):
        return "punctuation"
    parted = sum(map(words.count, SEPARATORS))
    if parted >= 2 and 4 * parted >= n:
        return "navigation"
    if n >= STUTTER and 2 * sum(map(eq, words, words[1:])) > n:
        return "boilerplate"
    if n <= STOCK_WORDS:
        low = line.translate(_LOWER).strip(" \t\n\r\x0b\x0c")
        if n <= MENU_WORDS and _MENU.match(low):
            return "navigation"
        if _STOCK.search(low):
            return "boilerplate"
    return None


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside `width`-word windows that occur at least twice, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    kinds = dict.fromkeys(words)
    if len(kinds) == len(words):
        return 0
    number = dict(zip(kinds, range(len(kinds))))
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    size = 1  # names of windows of 1, 2, 4, ... words: equal name, equal words
    while size < width:
        step = min(size, width - size)
        names = at[: len(at) - step] * (int(at.max()) + 1) + at[step:]
        at = np.unique(names, return_inverse=True)[1].astype(np.int64)
        size += step
    found = np.flatnonzero(np.bincount(at)[at] > 1)
    if not len(found):
        return 0
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + width, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def judge(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_bad_lines, n_kept_words, kept, clean text."""
    if text is None:
        return 0, 0, 0, 0, 0, True, 0, 0, False, None
    words, seen, clean = [], set(), []
    repeats = bad = kept = 0
    for line in text.split("\n"):
        own = line.encode("utf-8", "replace").split()  # ASCII white space only
        if own:
            words += own
            repeats += line in seen
            seen.add(line)
            if line_fault(line, own):
                bad += 1
                continue
            kept += len(own)
        clean.append(line)
    n = len(words)
    again = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * again > MAX_REPEATED * n
    fine = not base_failed and 100 * (n - kept) <= MAX_LOST * n
    return (n, len(text.translate(_WHITE)), len(_SYMBOL.findall(text)), repeats, again, base_failed, bad, kept, fine,
            "\n".join(clean) if bad else text)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
                  with_text: bool = True) -> DataFrame:
    """One row per row of `docs`: key, counts, base_failed, n_bad_lines, n_kept_words, kept, `carry`, clean_text.

    Words are runs of anything but space and U+0009 to U+000D.  Null texts have
    no words, fail the base rules and have a null clean text; so do empty ones, with an empty
    clean text.  Repeated rows and null keys are kept; an empty table gives an
    empty result.  Columns other than key, text and `carry` are not looked at;
    a carried column must not have the name of an output.
    """
    out = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "n_bad_lines long, n_kept_words long, kept boolean")
    return map_texts(pick(docs, key, *carry, text), (key, *carry), text, out + ", clean_text string" * with_text, lambda: columns(with_text))


def columns(with_text: bool):
    """From texts to the columns of `judge`."""
    def run(texts: list[str | None]) -> list[list]:
        found = [list(c) for c in zip(*map(judge, texts))] or [[]] * 10
        return found if with_text else found[:-1]
    return run
