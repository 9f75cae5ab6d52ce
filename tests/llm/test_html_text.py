from html import unescape
import re

from reshelve.llm import html_text as h


def article(html):
    """The article of a page of the table, whose mark-up is regular."""
    inside = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = re.split(r"<[^>]*>", re.sub(r"</?b>", "", inside))
    return " ".join(" ".join(unescape(part) for part in parts).split())


def test_query_equals_the_articles(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = h.op8_html_text(spark, folder).collect()
    assert sorted(r.page_id for r in found) == sorted(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def test_blocks_and_densities():
    found = h.blocks("<head><title>T</title></head><p>one <b>two</b>&nbsp;&amp; <a href='>'>three"
                     "</a><br>four<!-- no --><script>var x='</p>'</script>five<td>six &lt; < 7")
    assert [b.text for b in found] == ["one two & three four", "five", "six < < 7"]
    assert [(b.words, b.linked) for b in found] == [(5, 1), (1, 0), (4, 0)]
    assert h.features(found)[1] == (5.0, 0.2, 1.0, 0.0, 4.0, 0.0, 0.0, 0.0)


def test_labelled_pages_are_learned():
    tree = h.trained()
    right = [h.is_main(tree, row) == b.main for page in h.LABELLED_PAGES
             for b, row in zip(h.blocks(page), h.features(h.blocks(page)))]
    assert sum(right) / len(right) >= 0.95


def test_pages_of_another_make():
    tree = h.trained()
    page = """<body><div class="top-nav"><a href=/>Start</a> <a href=/b>Blog</a></div>
      <div class="post"><p>It took the team eleven months to build the telescope and three more
      to carry it up the mountain on foot.</p><p>On the first clear night they looked at Saturn
      and then nobody wanted to go down to the tents again for hours.</p></div>
      <section id="comments"><p>What a lovely story this is, I would have loved to be there with
      all of you on that first night.</p></section>
      <form><label>Your name and what you think of it</label></form>
      <noscript>Please switch scripts on to see all of the page</noscript></body>"""
    assert h.main_text(page, tree) == (
        "It took the team eleven months to build the telescope and three more to carry it up the "
        "mountain on foot. On the first clear night they looked at Saturn and then nobody wanted "
        "to go down to the tents again for hours.")


def test_odd_pages(spark):
    body = "<article><p>" + "many words in a row " * 30_000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<script>never closed"),
            (4, "u", body), (4, "u", body), (5, "u", "<<<>>> &#x; </p></div></article>"),
            (6, "u", "<article><p>Only &eacute;n&#233; &nbsp;\n two</article>"), (7, "u", "<!-- a"),
            (8, "u", '<article class="x')]
    table = spark.createDataFrame([(*r, 0, "y") for r in rows],
                                  "page_id long, url string, html string, n_chars int, text string")
    found = [(r.page_id, r.text, r.n_chars) for r in h.extract(table).collect()]
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)
    texts = dict((i, t) for i, t, _ in found)
    assert texts[1] == texts[2] == texts[3] == texts[7] == ""
    assert texts[6] == "Only éné two" and texts[4] == ("many words in a row " * 30_000).strip()
    assert h.extract(table.limit(0)).count() == 0


def test_layout_classes_do_not_hide_the_article():
    tree = h.trained()
    story = ("It took the team eleven months to build the telescope and three more to carry it up "
             "the mountain on foot.", "On the first clear night they looked at Saturn and then "
             "nobody wanted to go down to the tents again for hours.")
    inside = "".join(f"<p>{p}</p>" for p in story)
    side = "<div class=sidebar><p>Popular this week are these stories</p></div>"
    for body, around in (('class="has-sidebar"', "<div>{}</div>"), ('class="no-sidebar"', "<div>{}</div>"),
                         ("", '<div class="content with-sidebar">{}</div>'),
                         ("", '<article class="post has-comments">{}</article>'),
                         ("", "<div id='search-results'>{}</div>"),
                         ("", '<main class="legal-notice">{}</main>'),
                         ("", '<article class="legal-notice">{}</article>')):
        page = f"<body {body}>{around.format(inside)}{side}</body>"
        assert h.main_text(page, tree) == " ".join(story), page
    assert h.main_text(f"<article>{inside}</article><div id=comments>{inside * 3}</div>",
                       tree) == " ".join(story)
