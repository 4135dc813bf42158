import random
import time

import pytest

from cohortgraph.llm.line_blocks import main_text

LONG = "The quick brown fox jumps over the lazy dog and then some more words follow in this sentence to make it long."
MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(8)) + "</ul></nav>"
CASES = {
    "article": (f"<html><head><title>t</title><style>p{{}}</style></head><body>{MENU}<article><h1>Head &amp; more</h1><p>{LONG}<p>a&nbsp;b\n c&lt;"
                "<ul><li>one</ul></article><footer>f</footer>", f"Head & more\n{LONG}\na b c<\none"),
    "short article": (f"<body>{MENU}<article><p>Hi.</article><footer>&copy; x", "Hi."),
    "no article": (f"<body><header>Site</header>{MENU}<div id=content><h1>Head</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>"
                   f"<div class='sidebar'><p>{LONG}</p></div><footer>{LONG}</footer></body>", f"Head\n{LONG}\nYes.\n{LONG}"),
    "list in a plain page": (f"<div><p>{LONG}</p><ul><li>one</li><li>two</li></ul><table><tr><td>3</td></tr></table><p>{LONG}</p>"
                             "<ul>" + "<li><a href=x>more</a></li>" * 9 + "</ul></div>", f"{LONG}\none\ntwo\n3\n{LONG}"),
    "inside boxes": (f"<article><p>{LONG}</p><div class=\"ad box\"><div>{LONG}</div></div><aside>{LONG}</aside><p>End</p></article>"
                     f"<section id='comments'><p>{LONG}</p></section>", f"{LONG}\nEnd"),
    "script": ('<article><script>var t="</p>";</script>a<!-- <p>no -->b <noscript>x</noscript></article>', "ab"),
    "form and notice": (f"<body><div class=cookie-notice><p>{LONG}</p></div><main><p>{LONG}</p><form><p>{LONG}</p></form></main>", LONG),
    "unclosed nav": (f"<nav><a>x</a><article><p>{LONG}", LONG),
    "plain text": ("no markup at\n all", "no markup at all"),
    "empty": ("", ""),
    "broken reference": ("<article><p>a &am b &amp c", "a &am b & c"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, expected = CASES[name]
    assert main_text(page) == expected


def test_very_long_page():
    assert main_text("<article>" + f"<p>{LONG}</p>" * 20_000) == "\n".join([LONG] * 20_000)


def test_sums_decide_without_a_marked_article():
    """Flat pages against the definition: a line stays if a surge reaches it over sums above nothing."""
    draw = random.Random(5)
    found = 0
    for _ in range(300):
        lines = [(f"w{i} " + "x" * draw.choice([0, 3, 30, 90]), draw.random() < 0.4) for i in range(draw.randint(1, 25))]
        page = "<div>" + "".join(f"<p><a href=x>{t}</a></p>" if link else f"<p>{t}</p>" for t, link in lines) + "</div>"
        weights = [0 if link else len(t.strip()) for t, link in lines]
        sums = [sum(weights[i : i + 3]) for i in range(len(lines))]
        level = min(86, max(sums) / 4)
        starts = [i for i in range(len(lines)) if weights[i] and sums[i] >= level]
        kept = [t.strip() for i, (t, _) in enumerate(lines) if any(s <= i and all(sums[s : i + 1]) for s in starts)]
        assert main_text(page) == "\n".join(kept)
        found += 0 < len(kept) < len(lines)
    assert found > 50


ROLE_OF_THE_TAG = {
    "teaser card": (f"<body><article><p>Read on</p></article><div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>", f"Head\n{LONG}\n{LONG}"),
    "link line in the text": (f"<div><p>{LONG}</p><p><a href=x>all link</a></p><p>{LONG}</p></div>", f"{LONG}\nall link\n{LONG}"),
    "box in the text": (f"<div><p>{LONG}</p><div class=ad>{LONG}</div><p>End</p></div><div class=ad>x</div><div>far</div>", f"{LONG}\nEnd"),
    "links in the article": (f"<main><h1>T</h1><article><p>{LONG}</p>{'<p><a href=x>y</a></p>' * 4}</article></main>", f"T\n{LONG}" + "\ny" * 4),
}


@pytest.mark.parametrize("name", ROLE_OF_THE_TAG)
def test_the_article_tag_is_a_bonus(name):
    page, expected = ROLE_OF_THE_TAG[name]
    assert main_text(page) == expected


NAMES = {
    "title": (f'<body><div id=x><header class="entry-header"><h1>Title</h1></header><p>{LONG}</p></div>', f"Title\n{LONG}"),
    "title in a div": (f'<article><div class="article-header"><h1>Title</h1></div><p>{LONG}</p></article>', f"Title\n{LONG}"),
    "layout names": (f'<body><div id=content class="with-sidebar"><p>{LONG}</p></div>', LONG),
    "article without": (f'<article class="no-sidebar"><p>{LONG}</p></article>', LONG),
    "has a menu": (f'<div class="has-menu"><p>{LONG}</p></div>', LONG),
    "holds most of the text": (f'<div class="sidebar-layout">{MENU}<p>{LONG}</p><p>{LONG}</p><div class=ad>{LONG}</div></div><p>x</p>', f"{LONG}\n{LONG}"),
    "comments longer than the article": (f"<article><p>{LONG}</p></article><div id=comments>{f'<p>{LONG}</p>' * 4}</div>", LONG),
    "place before the name": (f'<div><p>{LONG}</p></div><div class="site-footer"><p>{LONG}</p></div><div class="main-nav">{LONG}</div>', LONG),
    "form around the page": (f"<body><form><div><p>{LONG}</p></div></form>", LONG),
    "open p": (f"<div><p class=notice>{LONG}<p>{LONG}<p>{LONG}</div>", f"{LONG}\n{LONG}"),
    "open p, parent closes": (f"<div><div><p class=notice>{LONG}</div>{LONG}</div>", LONG),
    "open li": (f"<div><ul><li class=menu-item>{LONG}<li>{LONG}</ul><p>{LONG}</div>", f"{LONG}\n{LONG}"),
    "nested li": (f"<ul><li class=menu-item>a<ul><li>{LONG}</ul>{LONG}<li>b</ul><p>{LONG}</p><p>{LONG}</p><p>{LONG}", f"b\n{LONG}\n{LONG}\n{LONG}"),
}


@pytest.mark.parametrize("name", NAMES)
def test_box_names_and_missing_end_tags(name):
    page, expected = NAMES[name]
    assert main_text(page) == expected


LINKS = {
    "anchor without href": (f"<body><a name=top><p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n{LONG}"),
    "unclosed link": (f"<div><p><a href=x>Go<p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    "link ends with its holder": (f"<div><li><a href=x>Go</li><p>{LONG}</p></div><a name=y></a>", LONG),
    "address in another attribute": (f"<p><a data-href=x>{LONG}</a></p>", LONG),
}


@pytest.mark.parametrize("name", LINKS)
def test_links(name):
    page, expected = LINKS[name]
    assert main_text(page) == expected


EDGES = {
    "plain menu and copyright": (f"<body><div>About</div><div>Contact</div><div><h1>Head</h1><p>{LONG}</p><p>Yes</p></div>"
                                 "<div>Copyright 2020 Foo Inc.</div><div>All rights reserved</div></body>", f"Head\n{LONG}\nYes"),
    "list before the text": (f"<body><ul><li>About<li>Contact</ul><h1>Head</h1><p>{LONG}</p><ul><li>one</ul>", f"Head\n{LONG}\none"),
    "counted comments": (f"<div><p>{LONG}</p><p>3 replies</p><div class=comments>{LONG}</div></div>", LONG),
    "paragraphs in boxes of their own": (f"<div><p>{LONG}</p></div><div><p>Yes.</p></div>", f"{LONG}\nYes."),
    "inside the article nothing is loose": (f"<article><div>About</div><div><p>{LONG}</p></div><div>Copyright</div></article>", f"About\n{LONG}\nCopyright"),
}


@pytest.mark.parametrize("name", EDGES)
def test_loose_edges(name):
    page, expected = EDGES[name]
    assert main_text(page) == expected


BROKEN = {
    "ends inside a tag": (f"<article><p>{LONG}</p><p>if a <b then c", f"{LONG}\nif a <b then c"),
    "apostrophe in a value": (f"<p title=don't>{LONG} isn't</p><p>{LONG}</p>", f"{LONG} isn't\n{LONG}"),
    "open quote": (f'<p title="x>{LONG}</p>', LONG),
    "quoted end": (f'<p title="a > b">{LONG}</p>', LONG),
    "list of options": (f"<datalist><option value=a><option value=b></datalist><p>{LONG}</p>", LONG),
    "option alone": (f"<option value=a><p>{LONG}</p>", LONG),
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_markup(name):
    page, expected = BROKEN[name]
    assert main_text(page) == expected


@pytest.mark.parametrize("piece", ["<div ", "<b ", "<a name=x", '<b "', "<b =\"", "<b '=\"", "<b \"=\"", "<script ", "</script ", "<script>", "<!", "<!--", "<?", "<", "</", "<p a=", "= <x"])
def test_a_megabyte_of_broken_markup_is_read_in_linear_time(piece):
    start = time.perf_counter()
    main_text(f"<article><p>{LONG}</p>" + piece * (2**20 // len(piece)))
    assert time.perf_counter() - start < 5
