"""Main text of pages without an article element, with icons and formulas, and below wrappers named after a state."""

from dayloom.llm.html_text import main_text

ENGLISH = "It was one of the days on which the sun is not to be seen and all of them were at home for the evening meal."
OTHERS = [
    "Вчера вечером городской совет принял решение построить новый мост через реку, чтобы разгрузить старую дорогу.",
    "Wczoraj wieczorem rada miejska podjęła decyzję, aby zbudować nowy most przez rzekę oraz odciążyć starą drogę.",
    "昨天晚上市议会决定在河上修建一座新桥，以减轻旧路的交通压力，工程预计明年春天开始。",
    "Belediye meclisi dün akşam nehrin üzerine yeni bir köprü yapılmasına karar verdi; çalışmalar baharda başlayacak.",
]


def page(*paragraphs, body="{}"):
    links = "".join(f"<li><a href={i}>Entry {i}</a></li>" for i in range(9))
    text = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<html><body><div>{links}</div>{body.format('<div>' + text + '</div>')}<footer><p>{ENGLISH}</p></footer></body></html>"


def test_languages_without_stop_words():
    for text in OTHERS:
        assert main_text(page(text, text, text)) == "\n".join([text] * 3)
    assert main_text(page(ENGLISH, OTHERS[1], ENGLISH)).split("\n") == [ENGLISH, OTHERS[1], ENGLISH]
    linked = "".join(f"<a href={i}>Сегодня новости города номер {i}</a> " for i in range(9))
    assert main_text(page(OTHERS[0], linked, OTHERS[0])) == "\n".join([OTHERS[0]] * 2)


def test_code_and_tables_between_prose():
    code = "def total(rows): return sum(row.price * row.amount for row in rows if row.amount > 0 and row.price)"
    cell = "Munich 1,482,200; Hamburg 1,892,122; Cologne 1,084,831; Frankfurt 773,068; Stuttgart 632,865; Leipzig 616,093"
    words = "cheap flights hotel rental car insurance travel deals beach resort cruise package discount vouchers"
    for tags, text in (("<pre>{}</pre>", code), ("<table><tr><td>{}</td></tr></table>", cell)):
        html = f"<div><p>{ENGLISH}</p>{tags.format(text)}<p>{ENGLISH}</p></div>"
        assert main_text(html) == f"{ENGLISH}\n{text}\n{ENGLISH}"
    assert main_text(f"<p>{ENGLISH}</p><p>{ENGLISH}</p><div>{words}</div>") == f"{ENGLISH}\n{ENGLISH}"  # key words stay out


def test_icons_and_formulas():
    assert main_text('<article><p>One <svg class="i"/> two</p><p>three</p></article>') == "One two\nthree"
    assert main_text('<article><p>One <svg><title>x</title><path d="M0 0"/></svg> two <svg /></p><p>3 <svg a="/">y</svg></p></article>') == "One two\n3"
    assert main_text('<article><p>So <math/> <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow>'
                     '<annotation encoding="application/x-tex">x=2</annotation></semantics></math> holds.</p><p>End.</p></article>') == "So x=2 holds.\nEnd."


def test_wrappers_that_are_no_furniture():
    text = f"{ENGLISH}\n{ENGLISH}"
    for attr in ('class="has-sidebar"', 'class="no-sidebar"', 'class="wide no-comments"', 'class="page-with-left-sidebar"', 'id="search-page"',
                 'class="without-menu"'):
        assert main_text(page(ENGLISH, ENGLISH, body=f"<div {attr}><article>{{}}</article></div>")) == text
        assert main_text(page(ENGLISH, ENGLISH, body=f"<div {attr}>{{}}</div>")) == text
    for attr in ('class="widget"', 'id="overlay"', 'class="search"'):  # a hint alone
        assert main_text(page(ENGLISH, ENGLISH, body=f"<div {attr}><article>{{}}</article></div>")) == text
        assert main_text(page(ENGLISH, ENGLISH, body=f"<div {attr}><div><main>{{}}</main></div></div>")) == text
    for attr in ("hidden", 'style="display: none"'):
        assert main_text(page(ENGLISH, body=f"<div {attr}><article>{{}}</article></div>")) == ""
    assert main_text(page(ENGLISH, body='<div class="sidebar no-padding">{}</div>')) == ""
    # comments and teasers are articles too
    assert main_text(f'<article><p>{ENGLISH}</p></article><div id="comments"><article><p>{OTHERS[1]}</p></article></div>') == ENGLISH
    assert main_text(f'<main><p>{ENGLISH}</p><div class="related"><article><p>{OTHERS[1]}</p></article></div></main>') == ENGLISH


PROSE = ("<p>The first paragraph of this text is long enough to be judged by the words that it has in it, and it is.</p>"
         "<p>This is the second of the paragraphs, and it has as many of the words as the first one, or more.</p>")
PLAIN = PROSE.replace("</p><p>", "\n").replace("<p>", "").replace("</p>", "")


def test_markup_that_must_not_lose_text():
    text = main_text
    assert text("<article><p title=it's>Hello world</p><p>don't stop</p></article>") == "Hello world\ndon't stop"
    assert text("<article><p>a <!--> b</p><p>c <!---> d <!-- x --!> e</p></article>") == "a b\nc d e"
    assert text("""<article><p title="a>b" lang='>'>kept</p></article>""") == "kept"
    for name in ('id="top"', 'class="layout-sidebar-right"', 'class="social-science"', 'class="has-sidebar"'):
        assert text(f"<div {name}>{PROSE}</div>") == PLAIN, name
    for name in ("related-work", "discussion"):
        assert text(f'<article><p>Intro.</p><section id="{name}">{PROSE}</section></article>') == "Intro.\n" + PLAIN, name


def test_furniture_by_name_still_goes():
    text = main_text
    for name in ("sidebar", "cookie-notice", "comments", "user-comments", "newsletter-box", "site-footer"):
        assert text(f'<div class="{name}">{PROSE}</div><article>{PROSE}</article>') == PLAIN, name
    assert text(f'<article>{PROSE}<div class="related"><p><a href=x>One more of these</a> <a href=y>and another one</a></p></div></article>') == PLAIN
    assert text(f'<article>{PROSE}<div class="related-posts"><p>Read on</p></div></article>') == PLAIN


def test_deep_pages_are_linear():
    import time
    for page in ("<div>hi " * 130_000, "<div>hi </p></b>" * 65_000, "<p a=\"b' " * 110_000):
        begun = time.time()
        main_text(page)
        assert time.time() - begun < 10  # some seconds at most; quadratic work took minutes
