"""Template deduction against a plain deduction from whole occurrence vectors, and on sites that no name list helps with."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestrand.llm import html_text


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def site(n, rng):
    """A page whose frame has neither telling tags nor telling names: a fixed bar, an optional block, a varying strip and the text."""
    letter = "<div class=xy><p>Keep reading</p><p>Our best stories by mail</p><p>every day</p></div>" if n % 2 else ""
    words = lambda k: " ".join(f"w{rng.randrange(500)}" for _ in range(k))
    return (
        f"<html><body><div class=qa><div>Home</div><div>World</div><div>Sport</div></div><div class=qb><h1>{words(4)}</h1><p>{words(60)}</p>{letter}<p>{words(40)}</p><p>Written by hand</p></div>"
        f"<div class=qc><div>{words(2)}</div></div><div class=qd><div>All rights</div><div>Contact us</div></div></body></html>"
    )


def plain_classes(pages, min_pages, min_class, min_support):
    """Tokens of the valid classes of one host, from whole occurrence vectors."""
    parsed = [[k for _, k, _ in html_text.parse(p)[1]] for p in pages if p and html_text.parse(p)[1]]
    if len(set(map(tuple, parsed))) < min_pages:
        return set()
    counts = [Counter(p) for p in parsed]
    vectors = {}
    for k in set().union(*counts):
        vectors.setdefault(tuple(c[k] for c in counts), set()).add(k)
    wide = {v: own for v, own in vectors.items() if len(own) >= min_class and sum(x > 0 for x in v) >= max(min_pages, min_support * len(parsed))}
    if not wide:
        return set()
    most = max((sum(x > 0 for x in v), len(own)) for v, own in wide.items())
    roots = [v for v, own in wide.items() if (sum(x > 0 for x in v), len(own)) == most]
    assert len(roots) == 1
    valid = set()
    for v, own in wide.items():
        orders = {tuple(k for k in p if k in own) for p, x in zip(parsed, v) if x}
        gaps = set()
        for p in parsed:
            gap = 0
            for k in p:
                gap += k in wide[roots[0]]
                if k in own:
                    gaps.add(gap)
        if len(orders) == 1 and (v == roots[0] or len(gaps) == 1):
            valid |= own
    return valid


@pytest.mark.parametrize("seed", range(2))
def test_valid_classes_by_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts, rows = {}, []
    for h in range(4):
        for n in range(rng.randint(9, 24)):
            page = site(n, rng)
            if h == 1 and n % 3 == 0:  # two parts of the frame change places: their class has no one order
                page = page.replace("<div>Home</div><div>World</div>", "<div>World</div><div>Home</div>")
            if h == 2:  # a block of several tokens that stands before the text on some pages and behind it on others
                block = "<table class=t><tr><td>One</td><td>Two</td></tr></table>"
                page = page.replace("<body>", "<body>" + block) if n % 2 else page.replace("</body>", block + "</body>")
            hosts.setdefault(h, []).append(page)
        hosts[h] += [None, "", hosts[h][0]]
    for h, pages in hosts.items():
        rows += [(len(rows), f"http://h{h}.example/{i}", p) for i, p in enumerate(pages)]
    df = frame(spark, rows).withColumn("host", F.lower(F.try_parse_url("url", F.lit("HOST"))))
    got = {r.host: {t + 2**63 for t in r.tokens} for r in html_text.templates(df).collect()}
    for h, pages in hosts.items():
        assert got.get(f"h{h}.example", set()) == plain_classes(pages, html_text.MIN_PAGES, html_text.MIN_CLASS, html_text.MIN_SUPPORT)


def test_template_decides_without_names(spark):
    rng = random.Random(1)
    rows = [(n, f"http://a.example/{n}", site(n, rng)) for n in range(30)] + [(100, "http://a.example/e", None), (101, "http://a.example/f", "")]
    got = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows)).collect()}
    for n, _, page in rows[:30]:
        alone = html_text.extract(page)
        assert "Home" in alone and "Contact us" in alone  # structure alone cannot tell
        lines = got[n].split("\n")
        assert not {"Home", "World", "Sport", "Keep reading", "Our best stories by mail", "All rights", "Contact us"} & set(lines)
        assert len(lines) == 4 and lines[-1] == "Written by hand" and all(line in alone for line in lines)
    assert got[100] == got[101] == ""
    off = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows), min_pages=10**9).collect()}
    assert all(off[n] != got[n] for n in range(30))


def test_names_do_not_cost_the_article():
    assert html_text.extract("<article class='social-policy'><p>a <math><mi>x</mi><mo>=</mo></math> b</p><div class='search-results-study'>c</div><div class='ad-slot'>no</div></article>") == "a x= b\nc"
    assert html_text.extract("<div class='comments'><p>the whole page is this</p></div>") == "the whole page is this"
    assert html_text.extract("<body><p>text that is longer</p><div class='comment-list'>me too</div></body>") == "text that is longer"


@pytest.mark.parametrize("tail", ["", "</span></p></section>", "</div>"])
def test_deep_pages_take_linear_time(tail):
    start = time.process_time()
    assert html_text.extract("<div class=abcdef>" * 100_000 + "x" + tail * 100_000) == "x"
    assert time.process_time() - start < 5


def test_forms():
    wrapped = "<body><form><div><p>Whole page in a form.</p></div></form></body>"
    assert html_text.extract(wrapped) == "Whole page in a form."
    assert html_text.extract("<body><p>A text of some length stands here.</p><form><p>Your mail</p><input><button>Go</button></form></body>") == "A text of some length stands here."
    assert html_text.extract("<body><form><label>Name</label><input></form></body>") == ""
    assert html_text.extract("<body><form><article><p>Within.</p></article><nav>Menu</nav></form></body>") == "Within."


@pytest.mark.parametrize("n", [2, 3, 7, 8])
def test_few_pages_of_a_host_make_a_template(spark, n):
    rng = random.Random(5)
    rows = [(i, f"http://few.org/{i}", site(i, rng)) for i in range(n)]
    texts = [r.text for r in html_text.main_text(frame(spark, rows)).collect()]
    assert len(texts) == n
    assert not any(line in t.split("\n") for t in texts for line in ("Home", "World", "Sport", "All rights", "Contact us"))
    assert all(len(t.split("\n")[1].split()) == 60 for t in texts)


def test_copies_of_a_page_make_no_template(spark):
    page = "<html><body><div class=qa><div>Home</div><div>World</div></div><div class=qb><h1>Title</h1><p>{}</p><p>The article itself.</p><p>And its end.</p></div></body></html>"
    rows = [(i, f"http://same.org/{i}", page.format(i)) for i in range(9)]
    assert all("The article itself." in r.text for r in html_text.main_text(frame(spark, rows)).collect())
