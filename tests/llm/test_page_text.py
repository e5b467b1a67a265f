import pytest

from tagtide.llm import page_text as P

LONG = "This is a sentence of the article that goes on for a while, as sentences in articles do."
PAGES = {
    "plain article": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no</p>';</script></head><body>"
        f"<nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class='ad'>Buy this now, it is cheap.</div>"
        f"<article><h1>Head</h1><p><b>{LONG}<br><p>Short.</p><p>{LONG}</p></article><footer>&copy; x</footer></body></html>",
        f"Head\n{LONG}\nShort.\n{LONG}",
    ),
    "character references and white space": (
        f"<article><p>a &amp; b &lt;c&gt; &eacute;\n\t &#8364; d&nbsp;e</p><p>{LONG}</p></article>",
        f"a & b <c> é € d e\n{LONG}",
    ),
    "no article element": (
        f"<body><div id='top-menu'><a href=1>One</a> <a href=2>Two</a></div><div><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div>"
        f"<div class='sidebar'><p>{LONG}</p></div><div id='comments'><p>{LONG}</p></div><form>{LONG}</form></body>",
        f"{LONG}\nBe.\n{LONG}",
    ),
    "notices, asides and comments within": (
        f"<main><div role='alert'>{LONG}</div><p>{LONG}</p><aside>{LONG}</aside><div class='cookie-notice'>{LONG}</div>"
        f"<section class='reader-comments'><p>{LONG}</p></section><p>End of it.</p></main>",
        f"{LONG}\nEnd of it.",
    ),
    "unclosed and stray tags": (
        f"<body></div></p><article><p>{LONG}<p>Second <i>part</b> here.<ul><li>One<li>Two</ul></article>",
        f"{LONG}\nSecond part here.\nOne\nTwo",
    ),
    "table": (f"<main><p>{LONG}</p><table><tr><td>a<td>b<tr><td>c</table></main>", f"{LONG}\na\nb\nc"),
    "header of the article stays": (
        f"<header>Site</header><article><header><h1>Head</h1></header><p>{LONG}</p></article>",
        f"Head\n{LONG}",
    ),
    "class of the article's header": (
        f"<div class='page-header'>{LONG}</div><article><div class='entryHeader'><h1>Head</h1></div><p>{LONG}</p>"
        f"<div class='entry-footer'>{LONG}</div></article>",
        f"Head\n{LONG}",
    ),
    "no markup": ("just  text", "just text"),
    "only boilerplate": ("<nav>Menu</nav><footer>Foot</footer>", ""),
    "comment and doctype": (f"<!doctype html><!-- <p>no</p> --><p>{LONG}</p>", LONG),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    html, wanted = PAGES[name]
    assert P.main_text(html) == wanted


def test_nothing_is_capped():
    paragraphs = [f"{i} {LONG}" for i in range(5_000)]
    html = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert P.main_text(html) == "\n".join(paragraphs)
    deep = "<div>" * 3_000 + LONG
    assert P.main_text(deep) == LONG


def test_smoothing_equals_a_plain_mean():
    values = [0.0, 10.0, 0.0, 0.0, 5.0]
    found = P.smoothed(values, 1.0)
    weights = [2.718281828459045 ** (-0.5 * d * d) for d in range(4)]
    for i, x in enumerate(found):
        near = [j for j in range(5) if abs(i - j) <= 3]
        assert x == pytest.approx(sum(weights[abs(i - j)] * values[j] for j in near) / sum(weights[abs(i - j)] for j in near))


def test_threshold_lies_between_two_clusters():
    assert 3 < P.threshold([1, 2, 3, 100, 120]) < 100
    assert P.threshold([7.0, 7.0]) == 7.0 and P.threshold([5.0, 7.0, 8.0]) == 5.0


def test_odd_rows(spark):
    rows = [(i, f"u{i}", html, 1, "t") for i, (html, _) in enumerate(PAGES.values())]
    rows += [(98, None, None, 1, "t"), (99, "u", "", 1, "t"), (None, "u", "<p>x</p>", 1, "t"), (0, "u0", rows[0][2], 1, "t")]
    schema = "page_id long, url string, html string, n_chars int, text string"
    found = P.extracted(spark.createDataFrame(rows, schema).repartition(3))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    texts = [(r.page_id, r.url, r.text, r.n_chars) for r in found.collect()]
    wanted = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES.values())]
    wanted += [(98, None, "", 0), (99, "u", "", 0), (None, "u", "x", 1), wanted[0]]
    assert sorted(texts, key=repr) == sorted(wanted, key=repr)
    assert P.extracted(spark.createDataFrame([], schema)).collect() == []


TEASER = "<article class='teaser'><h3><a href=1>More</a></h3><p>Read <a href=2>this</a>.</p></article>"


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        (f"<body><div class=post><p>{LONG}</p><p>{LONG}</p></div>{TEASER}{TEASER}</body>", f"{LONG}\n{LONG}"),
        (f"<body>{TEASER}<div class=post><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n{LONG}"),
        (f"<body><article><p>{LONG}</p><p>{LONG}</p></article>{TEASER}<div><a href=3>Next</a></div></body>", f"{LONG}\n{LONG}"),
        (f"<body><article><p>{LONG}</p></article><div><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div></body>", "\n".join([LONG, LONG, "Be.", LONG])),
        (f"<head><title>{LONG}</title></head><body><article><p>{LONG} {LONG}</p></article></body>", f"{LONG} {LONG}"),
    ],
)
def test_ratios_decide_between_elements_and_lines_outside(html, wanted):
    assert P.main_text(html) == wanted


@pytest.mark.parametrize(
    ("inside", "wanted"),
    [
        (f"<h2 id='search-methods'>Methods</h2><p>{LONG}</p>", f"Methods\n{LONG}"),
        (f"<section id='social-security'><p>{LONG}</p></section>", LONG),
        (f"<div class='related-work'><p>{LONG}</p></div>", LONG),
        (f"<section id='discussion'><p>{LONG}</p><p>{LONG}</p></section>", f"{LONG}\n{LONG}"),
        ("<div class='related-posts'><p><a href=1>One</a></p><p><a href=2>Two</a></p></div>", ""),
        (f"<div id='comments'><p>{LONG}</p></div><div class='cookie-notice'>{LONG}</div><div class='sideBar'>{LONG}</div>", ""),
        (f"<section id='ad-hoc-networks'><p>{LONG}</p></section><div class='ad'>{LONG}</div><div class='notice'>{LONG}</div>", LONG),
        ("<p><math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>", "x=2 holds."),
        ("<math><mtext>Let x be</mtext><p>one</p></math>", "Let x be\none"),
    ],
)
def test_names_inside_a_region(inside, wanted):
    found = P.main_text(f"<article><h1>Head</h1><p>{LONG}</p>{inside}</article>")
    assert found == "\n".join(x for x in ("Head", LONG, wanted) if x)


MENU = "<nav><a href=1>One</a></nav><div class='ad'>Buy it.</div>"


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        (f"<body><form id=aspnetForm action=/>{MENU}<article><h1>Head</h1><p>{LONG}</p></article></form></body>", f"Head\n{LONG}"),
        (f"<body><form action=/>{MENU}<div><p>{LONG}</p><p>{LONG}</p></div></form></body>", f"{LONG}\n{LONG}"),
        *[
            (f"<body><div {name}>{MENU}<article><p>{LONG}</p></article></div></body>", LONG)
            for name in (
                "class='layout has-sidebar'",
                "class='site no-sidebar'",
                "class='category-social'",
                "id='search-results-paper'",
                "class='page-with-banner'",
            )
        ],
        (f"<body><div class='site no-sidebar'><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n{LONG}"),
        (f"<body><div class='search-page'><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n{LONG}"),
        (f"<body><div class='article-header'><h1>Head</h1></div><div><p>{LONG}</p><p>{LONG}</p></div></body>", f"Head\n{LONG}\n{LONG}"),
        (f"<body><div class='ad'>{LONG} {LONG}</div><article><p>Short.</p></article></body>", "Short."),
        (f"<body><article><p>{LONG}</p></article><div class='sidebar'>{TEASER}{TEASER}</div></body>", LONG),
        (f"<body><p>{LONG}</p><ol class='comment-list'><li><article><p>{LONG} {LONG}</p></article></ol></body>", LONG),
        (f"<body><article><p>{LONG}</p></article><form><p>{LONG}</p><label>Name</label></form></body>", LONG),
    ],
)
def test_wrappers_and_forms_around_the_page(html, wanted):
    assert P.main_text(html) == wanted


@pytest.mark.parametrize(
    "control",
    [
        "<button>Copy link</button>",
        "<label>Name <input name=n></label>",
        "<textarea>typed</textarea>",
        "<select><option>one<option>two</select>",
        "<noscript><p>Turn it on</p><img src=x></noscript>",
        "<template><div><p>Not shown</p></div></template>",
        "<iframe src=x>No frames</iframe>",
        "<video src=x>No video</video>",
        "<object data=x>No object</object>",
        "<svg viewBox='0 0 1 1'><title>Icon</title><path d='M0'/></svg>",
        "<span style='color:red; display: none'>Hidden</span>",
        "<div style='display:none'><p>Hidden</p></div>",
        "<span hidden>Hidden</span>",
        f"<form><p>{LONG}</p></form>",
    ],
)
def test_controls_stand_ins_and_hidden_text(control):
    for html in (f"<article>{control}<p>{LONG}</p></article>", f"<body><div>{control}<p>{LONG}</p><p>{LONG}</p></div></body>"):
        assert set(P.main_text(html).split("\n")) == {LONG}
    inline = f"<article><p>{LONG} {control if '<p>' not in control or 'noscript' in control or 'template' in control else ''}And on.</p></article>"
    assert P.main_text(inline) == f"{LONG} And on."


def test_a_stray_tag_in_a_silent_element_closes_nothing():
    assert P.main_text(f"<article><p>{LONG} <svg></p></svg>And on.</p><p>{LONG}</p></article>").startswith(f"{LONG}")
