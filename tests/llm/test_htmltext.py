import time

import pytest

from skeinwork.llm import htmltext as H

LONG = "This is a long paragraph, with commas, and it goes on. It has several sentences, too."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("<script>var a = '<p>x</p>';</script>", ""),
        (f"<p>{LONG}</p>", LONG),
        (f"<article><h1>T</h1><p>{LONG}<p>Short.<p>a &lt;b&gt; &amp;amp; &#233;&nbsp;x</article>", f"T\n{LONG}\nShort.\na <b> &amp; é x"),
        (f"<nav><p>{LONG}</p></nav><div class='ad'>{LONG}</div><article><p>{LONG}</p></article><footer>{LONG}</footer>", LONG),
        (f"<article><p><b>{LONG}<br><p>two\n  lines\there</p></article>", f"{LONG}\ntwo lines here"),
        (f"<body class='has-sidebar'><main><p>{LONG}</p><ul><li>one<li>two</ul><form><p>mail</p></form></main><section id='comments'><p>{LONG} {LONG}</p></section>", f"{LONG}\none\ntwo"),
        (f"<div class='cookie-notice'>{LONG}</div><div role=banner>{LONG}</div><div hidden>{LONG}</div><div><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p><p>cut off &am", f"{LONG}\ncut off &am"),
        (f"<article><p>{LONG}</p></article><footer", LONG),
        (f"<style>p{{}}</style><!-- <p>no</p> --><article><p a='>'>{LONG}</p></article>", LONG),
        ("<p>x</p>", "x"),
    ],
)
def test_main_text(page, want):
    assert H.main_text(page) == want


def test_broken_markup_ends():
    for page in ("<" * 50_000, "<p " * 20_000, "<a href='" * 20_000, "<!--" * 20_000, "<div>" * 5000 + LONG, "&" * 50_000, "<p a=\"" + "x" * 100_000):
        H.main_text(page)


def test_rows_and_columns(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (None, None, f"<p>é {LONG}", 1), (1, "u", None, 1)], "page_id long, url string, html string, text int")
    rows = H.extract(pages).collect()
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in rows] == [(1, "", 0), (None, f"é {LONG}", len(LONG) + 2), (1, "", 0)]
    assert H.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><h1>T</h1><div class=body>{f'<p>{LONG}</p>' * 20}</div></article>", ["T", *[LONG] * 20]),
        (f"<div id=post><h1>T</h1><div class=body>{f'<p>{LONG}</p>' * 20}</div></div>", ["T", *[LONG] * 20]),
        (f"<article><section>{f'<p>{LONG}</p>' * 20}</section><section><p>{LONG}</p></section></article>", [LONG] * 21),
        (f"<body><div class=page><div class=a>{f'<p>{LONG}</p>' * 20}</div><div class=b><p>{LONG}</p></div></div>", [LONG] * 21),
        (f"<article><h1>T</h1><p>Short.</p><blockquote>{LONG * 20}</blockquote><p>End.</p></article>", ["T", "Short.", LONG * 20, "End."]),
        (f"<div><h1>T</h1><p>Short.</p><blockquote>{LONG * 20}</blockquote><p>End.</p></div>", ["T", "Short.", LONG * 20, "End."]),
        (f"<article><h1>T</h1><p>Short.</p><ul>{f'<li>{LONG}' * 20}</ul><p>End.</p></article>", ["T", "Short.", *[LONG] * 20, "End."]),
        (f"<article><h1>T</h1><p>Short.</p><table>{f'<tr><td>{LONG}<td>{LONG}' * 20}</table><p>End.</p></article>", ["T", "Short.", *[LONG] * 40, "End."]),
        (f"<article><h1>T</h1><p>Short.</p><p>{f'{LONG}<br>' * 20}</p><p>End.</p></article>", ["T", "Short.", *[LONG] * 20, "End."]),
        (f"<article><h1>T</h1>{f'<p>{LONG}</p>' * 9}<p><a href=x>The source of it all</a></p></article>", ["T", *[LONG] * 9, "The source of it all"]),
        (f"<body><h1>T</h1><article>{f'<p>{LONG}</p>' * 9}<p><a href=x>The source of it all</a></p></article>", ["T", *[LONG] * 9, "The source of it all"]),
        (f"<div class=x><p>{LONG}</p></div><article><h1>T</h1>{f'<p>{LONG}</p>' * 9}</article>", ["T", *[LONG] * 9]),
    ],
)
def test_nothing_else_of_an_article_is_dropped(page, want):
    assert H.main_text(page) == "\n".join(want)


MENU = "<div class=c1><a href=/a>Home</a> <a href=/b>About us</a></div>"
ADVERT = "<div class=c2>Buy two, get one.</div>"
FOOT = "<div class=c4><p>Privacy policy terms</p></div>"
BODY = f"<h1>T</h1><p>{LONG}</p><p>Short.</p><ul><li>one<li>two</ul><p>{LONG} {LONG}</p>"
WANT = ["T", LONG, "Short.", "one", "two", f"{LONG} {LONG}"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body>{MENU}{ADVERT}<div class=c3>{BODY}</div>{FOOT}</body>", WANT),
        (f"<body><div class=w>{MENU}<div class=c3>{BODY}</div>{ADVERT}</div>{FOOT}</body>", WANT),
        (f"<body>{MENU}<article>{BODY}</article>{ADVERT}{FOOT}</body>", WANT),
        (f"<body>{MENU}<main>{BODY}</main>{FOOT}</body>", WANT),
        (f"<article>{BODY}<div class='share'>Share Tweet</div><ul class=related><li><a href=x>More</a><li><a href=y>Other</a></ul></article>", WANT),
        (f"<article>{BODY}<section id=comments><p>{LONG}</p><p>{LONG}</p></section></article>", WANT),
        (f"<article>{BODY}<div class=alert><p>{LONG}</p></div><p class='related-work'>{LONG}</p><section id=form><p>{LONG}</p></section></article>", [*WANT, LONG, LONG, LONG]),
        (f"<article class=c1 id=menu><h1 class=c2 id=t>T</h1><p class=c3 id=p>{LONG}</p><div id=p><p>{LONG}</p></div></article>", ["T", LONG, LONG]),
    ],
)
def test_paths_decide_whatever_classes_are_called(page, want):
    assert H.content(page) == want


def test_the_path_step_decides_and_the_word_list_hardly(monkeypatch):
    pages = [f"<body>{MENU}{ADVERT}<div class=c3>{BODY}</div>{FOOT}</body>", f"<body><div class=w>{MENU}<div class=c3>{BODY}</div>{ADVERT}</div>{FOOT}</body>"]
    before = [H.content(p) for p in pages]
    for name in ("STRONG_FACTOR", "WEAK_FACTOR", "WEAK_INSIDE"):
        monkeypatch.setattr(H, name, 1.0)
    assert [H.content(p) for p in pages] == before
    monkeypatch.setattr(H, "LEAST", 0.0)
    assert all(a != b for a, b in zip([H.content(p) for p in pages], before))


def test_ratios_scores_and_threshold_against_plain_sums():
    page = f"<div class=a>{LONG}</div><div class=a>One, two.</div><div class=b>x</div><div class=c>Yes! No? <a href=z>linked text</a></div><div class=a>{LONG} {LONG}</div><div class=b>yy</div>"
    own = H.read(page)
    blocks = [(path, len(text) - linked, linked, len(H._PUNCTUATION.findall(text))) for path, text, linked in own.blocks]
    paths = {b[0] for b in blocks}
    number, text_ratio, mark_ratio, share = H.path_ratios(own)
    of = lambda p, i: [b[i] for b in blocks if b[0] == p]
    for p in paths:
        assert number[p] == len(of(p, 0)) and text_ratio[p] == pytest.approx(sum(of(p, 1)) / len(of(p, 0))) and mark_ratio[p] == pytest.approx(sum(of(p, 3)) / len(of(p, 0)))
        assert share[p] == pytest.approx(sum(of(p, 2)) / (sum(of(p, 1)) + sum(of(p, 2))))
    half = []
    for ratio, (low, high) in ((text_ratio, H.HALF_TEXT), (mark_ratio, H.HALF_MARKS)):
        half.append(min(high, max(low, sum(ratio[p] * n for p, n, *_ in blocks) / sum(n for _, n, *_ in blocks))))

    def smooth(ratio, i):
        return sum(w * ratio[blocks[min(len(blocks) - 1, max(0, i + d))][0]] for w, d in zip(H.KERNEL, (-2, -1, 0, 1, 2)))

    fused = [smooth(text_ratio, i) / (smooth(text_ratio, i) + half[0]) * (0.5 + smooth(mark_ratio, i) / (smooth(mark_ratio, i) + half[1])) / 1.5 for i in range(len(blocks))]
    score, plain, strongest, _ = H.path_scores(own, [0] * len(own.names))
    for p in paths:
        mine = [f for f, b in zip(fused, blocks) if b[0] == p]
        assert score[p] == plain[p] == pytest.approx(sum(mine) / len(mine) * (1 - share[p])) and strongest[p] == 0
    mean = sum(score[p] * (n + linked) for p, n, linked, _ in blocks) / sum(n + linked for _, n, linked, _ in blocks)
    chosen = H.chosen_paths(own, [0] * len(own.names))
    assert {p for p in paths if chosen[p]} == {p for p in paths if score[p] >= H.LEAST * mean} and 0 < sum(chosen) < len(paths)


SIX = "".join(f"<p>{LONG} {i}.</p>" for i in range(6))
PROSE = [f"{LONG} {i}." for i in range(6)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<main><article>{SIX}</article><article><p>{LONG} second</p></article></main>", [*PROSE, f"{LONG} second"]),
        (f"<body>{MENU}<article>{SIX}</article><article>{SIX}</article>{FOOT}</body>", [*PROSE, *PROSE]),
        (f"<body>{MENU}<p>{LONG} before</p><article>{SIX}</article><p>{LONG} after</p>{FOOT}</body>", [f"{LONG} before", *PROSE, f"{LONG} after"]),
        (f"<article>{SIX}<div class='quote'>Short quote.</div><div>Bare line of text in a div.</div></article>", [*PROSE, "Short quote.", "Bare line of text in a div."]),
        (f"<article>{SIX}<section id='comment'><p>{LONG}</p></section></article>", [*PROSE, LONG]),
        (f"<article>{SIX}<ol><li class=comment><p>{LONG}</p></li><li class=comment><p>{LONG}</p></li></ol></article>", PROSE),
        (f"<article>{SIX}<div class=ad><p>{LONG}</p></div><p class=ad>Buy now.</p><ul><li><a href=x>More</a><li><a href=y>Other</a></ul></article>", PROSE),
        (f"<body><div class=z><p>We use cookies to improve your visit. Please accept them.</p></div><article>{SIX}</article></body>", PROSE),
        (f"<body><div class=z><p>We use cookies to improve your visit. Please accept them.</p></div><div class=y>{SIX}</div></body>", PROSE),
        (f"<body><div class=sidebar><p>{LONG}</p></div><article>{SIX}</article><div class=comments><p>{LONG}</p></div></body>", PROSE),
    ],
)
def test_an_article_raises_its_paths_and_hides_no_others(page, want):
    assert H.content(page) == want


@pytest.mark.parametrize("name", sorted(H.STRONG | H.WEAK))
def test_names_on_paragraphs_of_an_article_do_not_drop_them(name):
    got = H.content(f"<article>{SIX}<p class='{name}'>Short.</p><p id='{name}'>{LONG}</p><h2 class='{name}'>Part</h2></article>")
    assert got == (PROSE if name in H.ADVERTS else [*PROSE, "Short.", LONG, "Part"])


def test_broken_pages_take_time_in_proportion():
    for part in ("<div>", "<b>", "<li>", "<p>", "<b></i>", "<div><li>", "<table><td>", "<h1>", "<div hidden>", "<a>x"):
        began = time.process_time()
        assert H.content(f"<body>{part * 200_000}text") is not None
        assert time.process_time() - began < 15, part
