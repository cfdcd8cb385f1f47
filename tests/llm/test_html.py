from __future__ import annotations

import json

import pytest

from ledgerloom.llm import html


def article_page(i, words="alpha beta gamma delta"):
    menu = "".join(f'<li><a href="/{w}{i}">{w} {i}</a></li>' for w in words.split())
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{x:1}}</style><script>var t='</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
        f'<div class="ad">Buy thing {i}!</div><article><h1>Title {i} &amp; more</h1><p>First  {i}\n<b>bold</b>.</p><p><b>Second {i}<br><p>Third &lt;{i}&gt;</p></article>'
        f'<section id="comments"><article class="comment"><p>Nice {i}</p></article></section><footer>&copy; site {i}</footer></body></html>'
    )


def article_text(i):
    return f"Title {i} & more\nFirst {i} bold.\nSecond {i}\nThird <{i}>"


def soup_page(i):
    return (
        f'<html><body><div id="top"><div>Fine Site</div><div><a href=a>Home</a> <a href=b>News {i}</a></div></div><div class="x1"><div><h2>Story {i}</h2>'
        f"<div>Long text of story {i} with enough words to weigh something, {'word ' * (i % 7 + 5)}</div><div>Read our daily letter</div><p>More of {i}<ul><li>point {i}<li>last {i}</ul></div></div>"
        f'<div class="sidebar"><p>Other things {i} {i}</p></div><form><input name=q>Search {i}</form><div>All rights kept</div></body></html>'
    )


def soup_text(i):
    return f"Story {i}\nLong text of story {i} with enough words to weigh something, {'word ' * (i % 7 + 5)}".strip() + f"\nMore of {i}\npoint {i}\nlast {i}"


def texts(spark, rows, extra=None):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = html.counted(html.extract(extra(df) if extra else df))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return sorted((r.page_id if r.page_id is not None else -1, r.text) for r in rows)


def test_articles_and_div_soup(spark):
    rows = [(i, f"https://WWW.a.example.com:80/p/{i}", article_page(i)) for i in range(20)]
    rows += [(100 + i, f"http://user@b.example.org/{i}?q", soup_page(i)) for i in range(20)]
    expected = [(i, article_text(i)) for i in range(20)] + [(100 + i, soup_text(i)) for i in range(20)]
    assert texts(spark, rows) == expected


def test_edge_rows(spark, clashing):
    long = "word " * 60_000
    rows = [
        (1, None, article_page(1)), (2, "", None), (3, "no url", ""), (None, "http://c.example/", article_page(3)), (4, "http://c.example/", article_page(4)),
        (4, "http://c.example/", article_page(4)), (5, "http://d.example", "<p>just text"), (6, "http://d.example", "<div>" * 3000 + "deep"),
        (7, "http://e.example", f"<article><p>{long}</article>"), (8, "http://e.example", "a < b <p class='x>y'>c</p"),
    ]
    found = texts(spark, rows, lambda df: clashing(df, "host", "wrapper", "text"))
    assert found[:5] == [(-1, article_text(3)), (1, article_text(1)), (2, ""), (3, ""), (4, article_text(4))] and found[5] == (4, article_text(4))
    assert dict(found)[5] == "just text" and dict(found)[6] == "deep" and dict(found)[7] == long.strip() and "c" in dict(found)[8]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(df).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><header><h1>T</h1><span>by x</span></header><p>a<footer>f</footer></article>", "T\na"),
        ("<main><p>a&nbsp;b&#233;&eacute;</p><aside>no</aside><pre>x\n  y</pre></main>", "a béé\nx y"),
        ("<body><div class='cookie-notice'>ok</div><article>a<div class='related'>r</div>b<table><tr><td>1<td>2</table></article>", "a\nb\n1\n2"),
        ("<article><p>x<script>if(a<b){'</p>'}</script>y<!-- c <p> -->z</p></article>", "x\nyz"),
        ("<article><p hidden>h</p><p>&amp;lt;</p></article>", "&lt;"),
    ],
)
def test_single_pages(page, text):
    assert html.Extractor(None).text(page) == text


def test_merging_is_the_same_in_any_parts():
    trees = lambda: [html.grouped(html.parse(p)) for p in (*map(article_page, range(6)), *map(soup_page, range(6)))]
    one = None
    for tree in trees():
        one = tree if one is None else html.merge(one, tree)
    parts = []
    for start in range(0, 12, 4):
        part = None
        for tree in trees()[start : start + 4]:
            part = tree if part is None else html.merge(part, tree)
        parts.append(html.unpack(json.loads(json.dumps(html.pack(part)))))
    two = parts[0]
    for part in parts[1:]:
        two = html.merge(two, part)
    assert [(g.label, g.pages, g.text, g.links) for g in one.walk()] == [(g.label, g.pages, g.text, g.links) for g in two.walk()]


def test_alignment_keeps_order():
    a, b = (html.grouped(html.parse(p)) for p in ("<div><h1>x</h1><p>y</p><table></table></div>", "<div><p>y</p><h1>x</h1><table></table><ul></ul></div>"))
    size, pairs = html._align(a.children[0], b.children[0], {})
    assert size == 3 and pairs in ([(0, 1), (2, 2)], [(1, 0), (2, 2)])
    merged = html.merge(a, b)
    assert [c.label for c in merged.children[0].children].count("table") == 1


def test_constant_blocks_of_an_article_go_and_copies_of_a_page_stay(spark):
    letter = lambda i: article_page(i).replace("<p><b>Second", "<p>Read our daily letter</p><div>Written by us</div><p><b>Second")
    rows = [(i, f"http://a.example/{i}", letter(i)) for i in range(12)] + [(100 + i, f"http://b.example/{i}", article_page(7)) for i in range(8)]
    assert texts(spark, rows) == [(i, article_text(i)) for i in range(12)] + [(100 + i, article_text(7)) for i in range(8)]


def test_a_constant_text_beside_many_others_is_found_on_any_number_of_pages(spark):
    def page(i):
        others = "".join(f"<div>Part {j} of story {i} with words</div>" for j in range(140))
        letter = "" if i % 10 == 3 else "<div>Read our daily letter</div>"  # on 9 pages of 10
        return f'<html><body><div class="x1">{letter}{others}</div></body></html>'

    rows = [(i, f"http://b.example/{i}", page(i)) for i in range(60)]
    expected = ["\n".join(f"Part {j} of story {i} with words" for j in range(140)) for i in range(60)]
    assert texts(spark, rows) == list(enumerate(expected))


def test_pages_of_very_many_blocks_keep_their_article(spark):
    def page(i):
        parts = "".join(f"<h2>Head {i} {j}</h2><p>Words {i} {j}</p>" for j in range(2200))
        return f"<html><body><div>outside {i}</div><article>{parts}</article></body></html>"

    rows = [(i, f"http://{'a' * (i + 1)}.example/{i}", page(i)) for i in range(2)]
    assert texts(spark, rows) == [(i, "\n".join(f"Head {i} {j}\nWords {i} {j}" for j in range(2200))) for i in range(2)]
