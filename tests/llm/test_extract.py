import itertools

import numpy as np

from tessera.llm import extract
from tests.llm.helpers import got

PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header class="top"><h1>Site name</h1><p>Our own slogan is long and has a full stop at its end.</p></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/x">News of the day</a></li></ul></nav>
<div class="sidebar"><p>Read also this other story, which is really long, on our pages.</p></div>
%s<div id="cookie-notice"><p>We use cookies to make this site better for everybody.</p></div>
<section class="comments"><p>Great text, I have read it twice and liked it, thanks.</p></section>
<form><p>Subscribe to our letter with the news of every week.</p><input value="x"></form>
<footer>&copy; All rights reserved by the owner of the site.</footer></body></html>"""
BODY = """<h2>A &quot;title&quot; &amp; more</h2><p>First  paragraph
with <b>bold</b> and <a href="#">link</a>&#33;</p><p>Yes.</p>
<div class="ad-box">Buy this now, it is cheap.</div><!-- <p>hidden</p> --><p>Last one is 3 &lt; 4, as <i>we</i> know<br>by now.</p>"""
TEXT = 'A "title" & more First paragraph with bold and link! Yes. Last one is 3 < 4, as we know by now.'


def test_kinds_of_boilerplate():
    assert extract.main_text(PAGE % f"<article>{BODY}</article>") == TEXT
    assert extract.main_text(PAGE % f"<div class='content'>{BODY}</div>") == TEXT
    assert extract.main_text(PAGE % f"<ARTICLE>{BODY}") .startswith(TEXT)


def test_unclosed_and_broken_markup():
    assert extract.main_text("<article><p>One long text with several words<p>and two.") == "One long text with several words and two."
    assert extract.main_text("<article><p title='a>b'>In.</p><p class=\"x>Out of quotes</p><p>End.</p></article>").startswith("In.")
    assert extract.main_text("<script>" * 3 + "x < y") == ""
    assert extract.main_text("<" * 2000) in ("", "<" * 2000)
    assert extract.main_text("<article><p>" + "word " * 50_000 + "</p></article>") == ("word " * 50_000).strip()


FIVE = [f"Paragraph {w} has enough words to be one of the article." for w in ("one", "two", "three", "four", "five")]


def five(after_first="", end=""):
    return "".join(f"<p>{t}</p>" + (after_first if i == 0 else "") for i, t in enumerate(FIVE)) + end


def test_no_text_is_lost_behind_dropped_elements():
    whole = " ".join(FIVE)
    for odd in ("<svg class='i'/>", "<svg><path d=''/>", "<svg><g><svg></svg></g></svg>", "<button>", "<button type='x'>", "<select>",
                "<video src='x'>", "<canvas>", "<iframe/>", "<button>Buy</button>", "<svg><text>drawn</text></svg>"):
        assert extract.main_text(f"<article>{five(odd)}</article>") == whole, odd
        assert extract.main_text(f"<article>{five(odd, '<button>Send</button><svg></svg>')}</article>") == whole, odd
    assert extract.main_text(f"<article>{five('<object><p>A fallback is part of the text of a page too.</p></object>')}</article>") == (
        " ".join([FIVE[0], "A fallback is part of the text of a page too.", *FIVE[1:]]))
    assert extract.main_text("<article><p>We know that <math><mi>a</mi><mo>=</mo><mn>4</mn></math> holds for all of them.</p></article>") == (
        "We know that a=4 holds for all of them.")


def test_names_of_what_holds_the_page():
    whole = " ".join(FIVE)
    for page in (f"<body class='has-sidebar'><article>{five()}</article></body>", f"<body class='ad widget'>{five()}</body>",
                 f"<div class='search'>{five()}</div>", f"<div id='sidebar-page'><div class='content'>{five()}</div></div>",
                 f"<main class='social'><div class='menu'><a href='/'>Home</a></div>{five()}</main>"):
        assert extract.main_text(page) == whole, page
    noise = "".join(f"<p>Reader {i} has read all of it and likes it very much indeed.</p>" for i in range(40))
    assert extract.main_text(f"<article>{five()}</article><div class='comments'><div class='text'>{noise}</div></div>") == whole


def test_many_blocks():
    import time

    rng = np.random.default_rng(1)
    page = "<article>" + "".join(
        f"<p>{'A sentence of the text that goes on. ' * 3}</p>" if rng.random() < 0.5 else "<div><li><a href='/'>Link</a></li></div>"
        for _ in range(20_000)) + "</article>"
    t = time.perf_counter()
    text = extract.main_text(page)
    assert time.perf_counter() - t < 20 and text.count("A sentence") > 25_000


def test_cut_of_large_graphs_is_minimal():
    """On a path with chords that do not cross, the least cut by dynamic programming over the path."""
    rng = np.random.default_rng(3)
    for n in (50, 2000):
        pull = list(rng.normal(0, 2, n))
        weight = rng.random(n - 1) * 2
        best = [0.0, 0.0]  # least cost with the last node on the sink's, the source's side
        for i in range(n):
            own = [max(pull[i], 0), max(-pull[i], 0)]
            w = weight[i - 1] if i else 0.0
            best = [own[k] + min(best[k], best[1 - k] + w) for k in (0, 1)]
        keep = extract.minimum_cut(pull, [(i, i + 1, weight[i]) for i in range(n - 1)])
        cost = (sum(p for p, k in zip(pull, keep) if p > 0 and not k) + sum(-p for p, k in zip(pull, keep) if p < 0 and k)
                + sum(w for w, a, b in zip(weight, keep, keep[1:]) if a != b))
        assert abs(cost - min(best)) < 1e-6


def test_cut_is_minimal():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        pull = list(rng.normal(0, 2, n))
        edges = [(a, b, float(rng.random())) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(keep):
            return (sum(p for p, k in zip(pull, keep) if p > 0 and not k) + sum(-p for p, k in zip(pull, keep) if p < 0 and k)
                    + sum(c for a, b, c in edges if keep[a] != keep[b]))

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert abs(cost(extract.minimum_cut(pull, edges)) - best) < 1e-6


def test_awkward_rows(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>", "x"), (1, "u", PAGE % f"<article>{BODY}</article>", "x"),
            (2, None, None, None), (None, "v", "", "x"), (3, "w", "   ", "x")]
    out = sorted(got(extract.extract(spark.createDataFrame(rows, schema))), key=repr)
    want = sorted(({"page_id": p, "url": u, "text": TEXT if p == 1 else "", "n_chars": len(TEXT) if p == 1 else 0}
                   for p, u, _, _ in rows), key=repr)
    assert out == want
    assert extract.extract(spark.createDataFrame([], schema)).collect() == []
