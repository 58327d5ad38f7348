import html as h
import random
import re

import numpy as np
import pytest

from brandspark.llm import html_extract as he
from brandspark.llm.common import read

ARTICLE = re.compile(r"<article>(.*?)</article>", re.S)


def article_text(page):
    """The text of the one article of a generated page, by plain pattern matching."""
    found = ARTICLE.search(page or "")
    return re.sub(r"[\x20\x09-\x0D]+", " ", h.unescape(re.sub(r"</?(?:p|h1|br)>", " ", found[1])).replace("<b>", "").replace("</b>", "")).strip(" ") if found else ""


def test_query_gives_the_articles(spark, sf):
    pages = {r.page_id: r for r in read(spark, sf, "pages").collect()}
    rows = he.query(spark, sf).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        want = article_text(re.sub(r"<b>|</b>", "", pages[r.page_id].html))
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url
    assert sum(r.n_repeated for r in rows) > 0


def page(body, head=""):
    return f"<!doctype html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        (page("<article><h1>A &amp; B</h1><p>one<b>two</b>\n three<p>four<br>five</article>"), "A & B onetwo three four five"),
        (page("<nav>menu</nav><main><div class='cookie-notice'>we bake</div><p>text &eacute;&#233;&#x1F600;</p><aside>more</aside></main><footer>f</footer>"), "text éé😀"),
        (page("<article><p>a<span class=ad>buy</span>b</p><form>name <input></form><script>var x='<p>no</p>'</script><style>p{}</style><section id=comments><p>first!</p></section></article>"), "ab"),
        (page("<div class='post-body'>the post</div><div class='sidebar'>side</div><div>rest</div>"), "the post"),
        (page("<main><p>intro</p><article><header>by line</header><p>the article</p><footer>end</footer></article></main>"), "the article"),
        (page("<article><p>cut off &am"), "cut off &am"),
        (page("<article><p>x</b></i></div> y</article> z"), "x y"),
        (page("<article></article><p>other</p>"), ""),
        (page("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>"), "one two a b"),
        (page("<article><!-- <p>no</p> --><p hidden>no</p><div role=navigation>no</div><![if x]><p>yes</p><![endif]></article>"), "yes"),
        (page("<article class=post><article class=comment><p>reader</p></article><p>own</p></article>"), "own"),
        (page("<div>" * 3000 + "<article>deep</article>"), "deep"),
    ],
)
def test_markup(html, text):
    main, rest = he.page_blocks(html or "")
    assert (" ".join(b[3] for b in rest if b[1] == he.OPEN) if main is None else main) == text


def test_repeats_of_a_host_go_where_markup_is_silent(spark):
    rng = random.Random(3)
    own = lambda: " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(30))
    notice = "this site is read by very many people every day of the year"
    texts = {k: own() for k in range(12)}
    body = lambda k: f"<div>{notice}</div><div>{texts[k]}</div><div>short{k}</div><p>{notice} {k}</p>"
    rows = [(k, f"http://{'a' if k < 8 else 'b'}.example/{k}", page(body(k))) for k in range(11)]
    rows += [(20, "http://c.example/", page(body(11))), (21, "http://c.example/", page(body(11))), (22, None, page(body(11))), (23, "odd", None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, cell int")
    for cell in (1 << 24, 600):  # one cell, and a host over several
        got = {r.page_id: r.text for r in he.extract(df, cell).collect()}
        for k in range(11):
            assert got[k] == f"{texts[k]} short{k} {k}", (cell, got[k])
        assert got[20] == got[21] == got[22] == f"{notice} {texts[11]} short11 {notice} 11"  # one page, three times
        assert got[23] == ""
    assert he.extract(df.limit(0)).collect() == []
    twice = he.extract(df.union(df)).collect()
    assert len(twice) == 30 and {(r.page_id, r.text) for r in twice} == set(got.items())


@pytest.mark.parametrize("seed", range(5))
def test_repeated_tokens_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 300))
    token = rng.integers(0, 3, n).astype(np.uint64)
    page = np.sort(rng.integers(0, 4, n))
    segment = np.cumsum(np.concatenate(([0], (np.diff(page) > 0) | (rng.random(max(0, n - 1)) < 0.05)))[:n])
    for run in (1, 3, 8):
        want, where = np.zeros(n, bool), {}
        for k in range(n - run + 1):
            if segment[k] == segment[k + run - 1]:
                where.setdefault(tuple(token[k : k + run]), []).append(k)
        for places in where.values():
            if len({page[k] for k in places}) > 1:
                for k in places:
                    want[k : k + run] = True
        assert (he.repeated_tokens(token, segment, page, run) == want).all()


def test_very_long_page(spark):
    text = " ".join(f"word{k}" for k in range(200_000))
    df = spark.createDataFrame([(1, "http://a.example/", page(f"<nav>m</nav><article><p>{text}</p></article>")), (2, "http://a.example/2", page(f"<p>{text}</p>"))], "page_id long, url string, html string")
    got = {r.page_id: r for r in he.extract(df).collect()}
    assert got[1].text == got[2].text == text and got[1].n_chars == len(text)


def test_repeats_of_a_host_decide_between_articles(spark):
    rng = random.Random(4)
    own = lambda n: " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(n))
    cards, long = [own(9) for _ in range(3)], own(200)
    card = lambda text: f"<div><article><h3>{text[:5]}</h3><p>{text}</p></article></div>"
    told = lambda text: f"{text[:5]} {text}"
    texts = {k: own(60) for k in range(8)}
    body = lambda text, *more: f"<nav>menu</nav><article><p>{text}</p></article>{''.join(map(card, more))}"
    want = {k: texts[k] for k in range(6)}  # cards that other pages show go
    rows = [(k, "a", body(texts[k], cards[k % 3], cards[(k + 1) % 3])) for k in range(6)]
    rows += [(6, "b", body(texts[6], cards[0]))]  # a host's only page: nothing is repeated
    want[6] = f"{texts[6]} {told(cards[0])}"
    rows += [(k, "c", f"<p>{k}</p>" + body(texts[7])) for k in (7, 8)]  # an only article stays, on whatever pages
    want[7] = want[8] = texts[7]
    rows += [(k, "d", f"<p>{k}</p>" + body(texts[7], cards[0])) for k in (9, 10)]  # nor does the larger of repeated ones go
    want[9] = want[10] = texts[7]
    short = {k: own(n) for k, n in ((11, 20), (12, 20), (13, 15), (14, 15))}
    rows += [(k, "e", body(short[k], long)) for k in (11, 12)]  # repeats outweigh what is the page's own
    want |= {k: f"{short[k]} {told(long)}" for k in (11, 12)}
    rows += [(k, "f", body(short[k], *cards[:2])) for k in (13, 14)]  # also together
    want |= {k: f"{short[k]} {told(cards[0])} {told(cards[1])}" for k in (13, 14)}
    rows += [(k, "g", f"<p>{k}</p>" + "".join(map(card, cards))) for k in (15, 16)]  # and nothing goes if all would
    want[15] = want[16] = " ".join(map(told, cards))
    df = spark.createDataFrame([(k, f"http://{host}.example/{k}", page(html)) for k, host, html in rows], "page_id long, url string, html string")
    for cell in (1 << 24, 900):  # one cell, and hosts over several
        got = {r.page_id: r for r in he.extract(df, cell).collect()}
        assert {k: r.text for k, r in got.items()} == want
        assert all(r.n_chars == len(r.text) for r in got.values())
        for k in range(6):
            assert he.page_blocks(rows[k][2])[0] != got[k].text  # markup alone would keep the cards
            assert got[k].n_repeated == len(told(cards[k % 3]).split()) + len(told(cards[(k + 1) % 3]).split())


def test_teasers_of_only_articles_go(spark):
    rng = random.Random(5)
    own = lambda n: " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(n))
    a, b, c, d = own(40), own(60), own(40), own(12)
    teaser = lambda text: f"<div><article><p>{text}</p></article></div>"
    start = " ".join(b.split()[:12])
    pages = {
        1: ("h", f"<article><p>{a}</p></article>{teaser(start)}"),  # the start of page 2, on this page alone
        2: ("h", f"<article><p>{b}</p></article>"),
        3: ("g", f"<article><p>{c}</p></article>{teaser(start)}"),  # another host: nothing is repeated
        4: ("h", f"<article><p>{c}</p></article>{teaser(d)}{teaser(' '.join(c.split()[:12]))}"),  # of its own article, and of none
        5: ("h", f"<p>{a}</p>"),  # markup is silent: a copy of an article stays
    }
    want = {1: a, 2: b, 3: f"{c} {start}", 4: f"{c} {d} {' '.join(c.split()[:12])}", 5: a}
    df = spark.createDataFrame([(k, f"http://{host}.example/{k}", page(body)) for k, (host, body) in pages.items()], "page_id long, url string, html string")
    for cell in (1 << 24, 700):  # hosts that share a cell, and one over several
        assert {r.page_id: r.text for r in he.extract(df, cell).collect()} == want
