"""Template deduction: equal vectors, nesting, slots, and the text of varied pages."""

from loanloom.llm import templates as tp
from loanloom.llm.storage import Scratch


def solve(spark, rows):
    frame = spark.createDataFrame([(h, i, u, "x") for i, u, h in rows], "html string, page_id bigint, url string, slot string").repartition(3)
    return sorted(((r.page_id, r.text) for r in tp.main_text(frame, Scratch(spark, "pages")).collect()), key=str)


def full(title, body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header><p>Site name</p></header><nav><ul><li><a href='/a'>Home</a><li><a href=\"/b>c\">More</a></ul></nav>"
            f"<div class='cookie-notice'><p>We use cookies</div><article><h1>{title}</h1>{body}</article>{extra}<footer>&copy; us</footer></body></html>")


def test_articles(spark):
    rows = [
        (1, "https://a.example/1", full("One", "<p><b>First <i>par</i>t<br><p>A &amp; B\n\n c&nbsp;d<ul><li>x<li>y</ul>")),
        (2, "https://a.example/2", full("Two", "<p>Same words</p><form><input>Send</form><!-- <p>no</p> -->")),
        (3, "https://a.example/3", full("Three", "<p>Same words</p>", "<aside><p>Side</p></aside><section class='comments'><article><p>Nice!</p></article></section>")),
        (4, "https://A.example:80/4", full("Four", "<p>1 < 2 and 3 > 2</p>")[:-30]),
        (5, "https://alone.example/", full("Alone", "<div class='ad'>Buy</div><p>only one <p>page")),
        (6, None, full("Lost", "<p>no url")), (7, "nonsense", None), (8, "https://a.example/8", ""), (9, "https://a.example/9", "plain text"),
        (2, "https://a.example/2", full("Two", "<p>Same words</p><form><input>Send</form><!-- <p>no</p> -->")),
        (10, "https://b.example/", "<article><p>" + "long " * 40_000), (11, "https://b.example/", "<p" * 2_000),
    ]
    got = dict(solve(spark, rows))
    assert got == {
        1: "One First part A & B c d x y", 2: "Two Same words", 3: "Three Same words", 4: "Four 1 < 2 and 3 > 2", 5: "Alone only one page",
        6: "Lost no url", 7: "", 8: "", 9: "plain text", 10: " ".join(["long"] * 40_000), 11: ""}
    assert len(solve(spark, rows)) == len(rows)


def test_host_without_article_uses_its_template(spark):
    """The slot is the innermost template element with most running text; text on every page is template."""
    page = ("<html><body><div class=wrap><div class=top><p>Welcome to the site</p></div><div class=content><p>{0}</p><p>{1}</p>"
            "<p>Read our terms</p></div><div class=bottom><p>Made here</p></div></div></body></html>")
    rows = [(i, "http://c.example/x", page.format(f"Body {i} with quite a few words in it", f"Second part of body {i} goes on and on")) for i in range(6)]
    assert solve(spark, rows) == [(i, f"Body {i} with quite a few words in it Second part of body {i} goes on and on") for i in range(6)]
    frame = spark.createDataFrame([("h", i, h) for i, _, h in rows], "host string, page_id bigint, html string")
    found = tp.deduce(tp.occurrences(frame)).collect()
    assert len(found) == 1 and found[0].slot.endswith("div.content") and len(found[0].fixed) == 3 and found[0].depth >= 3


def test_template_text_inside_articles_goes(spark):
    """Text that every page of a host repeats is template, also in an article; elsewhere the same words stay."""
    page = "<html><body><nav>Home</nav><article><h1>T{0}</h1><p>Body {0}</p><div><p>Subscribe for more</p></div>{1}</article></body></html>"
    rows = [(i, "http://d.example/", page.format(i, "<h2>Subscribe for more</h2>" if i == 3 else "")) for i in range(6)]
    rows += [(i, "http://copies.example/", page.format("same", "")) for i in (10, 11, 12)]
    want = [(i, f"T{i} Body {i}" + " Subscribe for more" * (i == 3)) for i in range(6)]
    assert solve(spark, rows) == sorted(want + [(i, "Tsame Body same Subscribe for more") for i in (10, 11, 12)], key=str)


def test_shared_articles_stay(spark):
    """An article on half of a host's pages is no template, whatever differs beside it; a notice on all of them is."""
    page = ("<html><body><nav>Home</nav><article><h1>Title {0}</h1><p>Body {0} of some length</p><p>More of {0}</p>{2}</article>"
            "<aside><p>Related {1}</p></aside></body></html>")
    notice = "<div><p>Subscribe for more</p></div>"

    def host(name, bodies, inside=lambda i: notice):
        return [(i, f"http://{name}/", page.format(b, i, inside(i))) for i, b in enumerate(bodies)]

    def text(b, tail=""):
        return f"Title {b} Body {b} of some length More of {b}{tail}"

    assert solve(spark, host("two.example", "AA")) == [(i, text("A", " Subscribe for more")) for i in range(2)]
    assert solve(spark, host("four.example", "AABC")) == [(i, text(b)) for i, b in enumerate("AABC")]
    assert solve(spark, host("six.example", "AAABCD")) == [(i, text(b)) for i, b in enumerate("AAABCD")]
    # boxes inside the article differ from page to page: its own text is most of the slot and stays
    boxes = solve(spark, host("boxes.example", "AAABCD", lambda i: f"{notice}<div><p>Box {i}</p></div>"))
    assert boxes == [(i, text(b, f" Box {i}")) for i, b in enumerate("AAABCD")]
    copies = [(i, "http://x.example/", page.format("A", 0, notice)) for i in range(5)]
    assert solve(spark, copies) == [(i, text("A", " Subscribe for more")) for i in range(5)]


def test_wrapper_with_a_listed_class_keeps_its_text(spark):
    page = ("<html><body class='has-sidebar'><div class='top'><p>Site</p></div><div class='social-post'><p>Words of {0} that run on</p>"
            "<article><p>Text of {0} that runs on and on</p><div class='share'><p>Share {0}</p></div></article></div>"
            "<div class='sidebar'><p>Aside {0}</p></div></body></html>")
    rows = [(i, "http://e.example/", page.format(i)) for i in range(4)]
    rows += [(10 + i, "http://f.example/", page.format(i).replace("article", "section")) for i in range(4)]
    assert solve(spark, rows) == sorted(
        [(i, f"Text of {i} that runs on and on") for i in range(4)]
        + [(10 + i, f"Words of {i} that run on Text of {i} that runs on and on") for i in range(4)], key=str)


def test_equal_vectors_form_classes(spark):
    frame = spark.createDataFrame([("h", 1, "<ul><li>a<li>b</ul><p>x"), ("h", 2, "<ul><li>a<li>c<li>d</ul><p>y"), ("h", 3, "<p>z")],
                                  "host string, page_id bigint, html string")
    rows = {(r.path, r.page): r.n for r in tp.occurrences(frame).collect() if not r.chunk}
    assert sorted(n for (path, _), n in rows.items() if path == "ul>li") == [2, 3]
    assert sorted(n for (path, _), n in rows.items() if path == "ul") == [1, 1]


def test_empty(spark):
    assert solve(spark, []) == []
