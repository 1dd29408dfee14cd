"""Main text of HTML pages by block rules in two passes.

A page is cut into blocks at block-level tags; every block has its text, the
share of it inside links, the share of stop words among its words, and the kind of
element that holds it.  Pass one decides what is clear: blocks in page furniture or with
many links are bad, long blocks with many stop words are good.  Long blocks with few of them
outside an article are good on a page in a language without stop words here; on a page with
them they are ambiguous if they are code, a table or sentences, else bad.  Pass two gives each
ambiguous block (short, or few stop words inside an article) the label of
the nearest decided neighbours of its article, or of the page outside one.

Scale: a narrow map over whole pages, no shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import map_texts, pick

#: Share of a block's characters inside links above which it is bad, outside and inside an article.
MAX_LINKS, MAX_LINKS_ARTICLE = 0.33, 0.5
#: Characters from which a block is judged by its stop words, and their shares.
LENGTH = 70
STOP_HIGH, STOP_LOW = 0.15, 0.05

#: Letters that stand for a syllable or a word count as so many characters more.
_WIDE, WIDE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]"), 2
#: Elements whose text has few stop words in any language.
DATA = frozenset(("pre", "table"))
SENTENCE_ENDS = ".!?…。！？:"

#: The most frequent words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous on ou par pas pour qui que sa se ses son sur un une vous "
    "als am an auf aus bei das dem den der des die durch ein eine einer er es für hat ich im in ist mit nach nicht oder sich sie sind und von war wie zu zum zur "
    "al como con de del el en es esta este la las lo los más no o para pero por que se si sin son su sus un una y ya".split())

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements whose text never belongs to the article.
FURNITURE = frozenset("aside button dialog fieldset footer form head menu nav option select title".split())
ARTICLE = frozenset(("article", "main"))
#: Elements whose content is not text; of a formula only its annotations, which repeat it in another notation.
RAW = "script|style|noscript|template|textarea|iframe|object|svg|annotation-xml|annotation|canvas|audio|video|map"
#: Those of them that a tag may close itself.
EMPTY = "svg|annotation-xml|annotation"

_SURE = (r"ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification|comments?|commentlist|reply|replies|respond|disqus|"
         r"newsletter|subscribe|subscription|popup|modal|overlay|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|pagination|pager|toolbar|login|signup|"
         r"copyright|disclaimer|complementary|contentinfo|skip|hidden")
_NAMES = r"banner|sidebar|rail|share|sharing|social|recommend\w*|widget|search"
_PLACES = r"header|topbar|top|bottom|side"
#: What marks furniture in `class`, `id` or `role`: these words as parts of a name, those as whole names.
_HINT = re.compile(rf"(?:^|[\s_-])(?:{_SURE})(?:$|[\s_-])|(?:^|\s)(?:{_NAMES})(?:$|\s)", re.IGNORECASE)
#: What marks furniture if the element is short or mostly links.
_WEAK = re.compile(rf"(?:^|[\s_-])(?:{_NAMES}|related|discussion)(?:$|[\s_-])", re.IGNORECASE)
#: Also these, unless the element lies in an article.
_WEAK_OUTSIDE = re.compile(rf"(?:^|[\s_-])(?:{_PLACES})(?:$|[\s_-])", re.IGNORECASE)
#: Long blocks from which on an element is not short.
PROSE = 2
#: What names a state or a whole page, not the element: no hint.
_STATE = re.compile(r"(?<![^\s_-])(?:has|no|with|without)[_-]\S*|\S+[_-](?:page|layout|template)(?!\S)", re.IGNORECASE)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: Attributes of a tag: a quote opens a value only after an equals sign.
_ATTRS = r"(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+"
_TOKEN = re.compile(
    r"(?P<text>[^<]+)"
    r"|<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?:" + EMPTY + r")(?=[\s/>])" + _ATTRS + r"(?<=/)>"
    r"|<(?P<raw>" + RAW + r")(?=[\s/>])" + _ATTRS + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>" + _ATTRS + r")>"
    r"|<[a-z/!?][^>]*>"
    r"|(?P<open><)", re.IGNORECASE | re.DOTALL)
_WORD = re.compile(r"[^\W\d_]+")
_COPYRIGHT = re.compile(r"©|\(c\)\s|copyright|all rights reserved", re.IGNORECASE)


class Block(NamedTuple):
    text: str
    links: float
    furniture: bool
    article: int
    heading: bool
    data: bool = False
    weak: int = 0


#: Furniture by a weak hint, by class, id or role alone, and by its element or because it is not shown.
WEAK, HINTED, CERTAIN = 1, 2, 3


def _furniture(tag: str, attrs: str, in_article: bool) -> int:
    if tag in FURNITURE or tag == "header" and not in_article:
        return CERTAIN
    if not attrs or tag in ARTICLE or tag in ("html", "body"):
        return 0
    found = 0
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            return CERTAIN
        if name in ("class", "id", "role") and found < HINTED:
            plain = _STATE.sub(" ", value)
            if _HINT.search(value) and _HINT.search(plain):
                found = HINTED
            elif any(h.search(value) and h.search(plain) for h in ((_WEAK,) if in_article else (_WEAK, _WEAK_OUTSIDE))):
                found = WEAK
    return found


def blocks(page: str) -> list[Block]:
    """The page's blocks that have text, in page order."""
    found: list[Block] = []
    open_tags: list[tuple[str, int, int, int]] = []  # tag, furniture, article, weakly hinted element (0: none)
    depth: Counter = Counter()  # open elements by tag
    doubtful: set[int] = set()  # articles in furniture by hint: comments and teasers, unless the page has no other article
    parts: list[tuple[str, bool]] = []  # text, inside a link
    links = articles = weaks = 0
    heading = False
    outside = ("", 0, 0, 0)

    def push(tag: str, furniture: int, article: int, weak: int) -> None:
        open_tags.append((tag, furniture, article, weak))
        depth[tag] += 1

    def pop() -> str:
        tag = open_tags.pop()[0]
        depth[tag] -= 1
        return tag

    def flush() -> None:
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = sum(len("".join(p.split())) for p, inside in parts if inside)
                _, furniture, article, weak = open_tags[-1] if open_tags else outside
                found.append(Block(text, linked / max(1, len(text.replace(" ", ""))), furniture > WEAK, article, heading,
                                   any(depth[t] for t in DATA), weak))
            parts.clear()

    last = page.rfind(">")
    for m in _TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            parts.append((entities.unescape(text), links > 0))
        elif m["open"] is not None:
            if m.start() > last and re.match(r"[a-z/!?]", page[m.end():m.end() + 1], re.IGNORECASE):
                break  # a tag that the page's end cuts off
            parts.append(("<", links > 0))
        elif m["tag"] is None:
            continue
        else:
            tag = m["tag"].lower()
            if tag in ("br", "wbr", "mtd"):
                parts.append(("" if tag == "wbr" else " ", links > 0))
                continue
            if tag == "a":
                links = max(0, links - 1) if m["end"] else 1
            if tag not in BLOCKS:
                if not m["end"] and tag not in VOID and not m["attrs"].rstrip().endswith("/"):
                    own = open_tags[-1] if open_tags else outside
                    if own[1] <= WEAK and (kind := _furniture(tag, m["attrs"], own[2] > 0)) > WEAK:  # an inline element that is furniture is cut off
                        flush()
                        push(tag, kind, own[2], own[3])
                elif m["end"] and open_tags and open_tags[-1][0] == tag:
                    flush()
                    pop()
                continue
            flush()
            links = 0
            heading = not m["end"] and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            if tag in VOID:
                continue
            if m["end"]:
                if depth[tag]:
                    while pop() != tag:
                        pass
                continue
            # an open paragraph ends where the next block starts; a list entry ends at the next one
            while open_tags and (open_tags[-1][0] == "p" or open_tags[-1][0] == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th")):
                pop()
            _, furniture, article, weak = open_tags[-1] if open_tags else outside
            if tag in ARTICLE and (furniture in (WEAK, HINTED) or not article and not furniture):
                articles += 1
                article = articles
                if furniture and tag != "main":
                    doubtful.add(article)
                furniture = weak = 0
            if furniture != CERTAIN:
                kind = _furniture(tag, m["attrs"], article > 0)
                if kind == WEAK and not weak:
                    weaks += 1
                    weak = weaks
                furniture = max(furniture, kind)
            push(tag, furniture, article, weak)
    flush()
    if weaks:
        found = _settled(found)
    if doubtful and any(b.article and b.article not in doubtful and not b.furniture and _length(b.text) >= LENGTH for b in found):
        found = [b._replace(furniture=True) if b.article in doubtful else b for b in found]
    return found


def _settled(found: list[Block]) -> list[Block]:
    """Blocks of weakly hinted elements are furniture where the element has few long blocks, or its text is mostly links."""
    prose, total, linked = Counter(), Counter(), Counter()
    for b in found:
        if b.weak and not b.furniture:
            n = _length(b.text)
            prose[b.weak] += n >= LENGTH and b.links <= MAX_LINKS
            total[b.weak] += n
            linked[b.weak] += n * b.links
    bad = {w for w in total if prose[w] < PROSE or 2 * linked[w] > total[w]}
    return [b._replace(furniture=True) if b.weak in bad else b for b in found]


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + WIDE * len(_WIDE.findall(text))


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def covered(found: list[Block]) -> bool:
    """Whether half of the page's long text, at least, is in a language with stop words here."""
    known = total = 0
    for b in found:
        if not b.furniture and b.links <= MAX_LINKS and (n := _length(b.text)) >= LENGTH:
            total += n
            known += n * (_stop_share(b.text) >= STOP_LOW)
    return known * 2 >= total


def first_pass(block: Block, known: bool = True) -> bool | None:
    """True: good, False: bad, None: ambiguous.  `known`: whether the page's language has stop words here."""
    if block.furniture or block.links > (MAX_LINKS_ARTICLE if block.article else MAX_LINKS):
        return False
    if _length(block.text) < LENGTH:
        return False if not block.article and _COPYRIGHT.search(block.text) else None
    share = _stop_share(block.text)
    if share >= STOP_HIGH:
        return True
    if block.article or share >= STOP_LOW:
        return None
    if not known:
        return True
    return None if block.data or block.text[-1] in SENTENCE_ENDS else False


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Ambiguous blocks inherit from the nearest decided neighbours of their article (or of the page's rest).

    Neighbours at equal distance that disagree, or none at all: good inside an
    article.  Outside one a heading takes the label that follows; else the block
    is bad between disagreeing neighbours, and without any it is good if it ends a sentence.
    Inside an article a heading is bad only if all decided neighbours are.
    """
    out: list[bool] = []
    before: dict[int, tuple[int, bool]] = {}
    after: list[tuple[int, bool] | None] = [None] * len(found)
    nearest: dict[int, tuple[int, bool]] = {}
    for i in range(len(found) - 1, -1, -1):
        after[i] = nearest.get(found[i].article)
        if labels[i] is not None and not found[i].furniture:
            nearest[found[i].article] = (i, labels[i])
    for i, (block, label) in enumerate(zip(found, labels)):
        if label is None:
            a, b = before.get(block.article), after[i]
            if a is None and b is None:
                label = block.article > 0 or block.text[-1] in SENTENCE_ENDS
            elif block.article and block.heading:
                label = bool(a and a[1] or b and b[1])
            elif a is None or b is None or a[1] == b[1]:
                label = (a or b)[1]
            elif block.heading:
                label = b[1]
            elif i - a[0] == b[0] - i:
                label = block.article > 0
            else:
                label = a[1] if i - a[0] < b[0] - i else b[1]
        elif not block.furniture:
            before[block.article] = (i, label)
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The good blocks of a page, one per line; empty for null, empty or textless pages."""
    if not page:
        return ""
    found = blocks(page)
    known = all(b.article or b.furniture for b in found) or covered(found)  # only blocks outside an article depend on it
    return "\n".join(b.text for b, good in zip(found, second_pass(found, [first_pass(b, known) for b in found])) if good)


def extract(pages: DataFrame, key: str = "page_id", page: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per row of `pages`: key, `carry`, text, n_chars (code points).

    Null, empty and textless pages have an empty text.  Markup may be broken or unclosed anywhere.
    Repeated rows and null keys are kept; an empty table gives an empty result;
    other columns are not looked at.
    """
    def run(texts: list[str | None]) -> list[list]:
        found = [main_text(t) for t in texts]
        return [found, [len(t) for t in found]]

    return map_texts(pick(pages, key, *carry, page), (key, *carry), page, "text string, n_chars long", lambda: run)
