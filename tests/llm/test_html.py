import time
import tracemalloc

import pytest

from strata.llm import html_extract, queries

PAGE = "page_id long, url string, html string"
SIDE = "<div class='col-a'><p>{}</p></div>"


def _page(body, title="T"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul><li><a href=/x>menu</a></li></ul></nav><!-- note --><div class=\"ad\">buy</div>{body}"
        "<footer>&copy; all</footer></body></html>"
    )


CASES = [
    ("<article><h1>Head &amp; more</h1><p><b>One two<br><p>three\n  four</p></article>", "Head & more One two three four"),
    ("<div class='post-12'><p>First para of the text.</p><p>Second &lt;b&gt; para.</p><div class='comments'><p>nice post, a long reader comment here</p></div></div>", "First para of the text. Second <b> para."),
    ("<main><p>a<span>b</span> c</p><form>name <input> <button>go</button></form><aside>see also</aside><ul><li>x<li>y</ul></main>", "ab c x y"),
    ("<article><p>text &amp text &#233; &eacute;&nbsp;end</p><div style='display: none'>hidden</div><p hidden>no</p></article>", "text & text é é end"),
    ("<article><p>one</p><table><tr><td>two<td>three</table><blockquote>four</blockquote></article>", "one two three four"),
]


@pytest.mark.parametrize(("body", "want"), CASES)
def test_article_without_boilerplate(body, want):
    assert html_extract.text_of(html_extract.parse(_page(body)), None) == want


def test_hosts_agree_on_a_path(spark, scratch):
    """A page whose own best container is an odd block follows the path its host voted for."""
    usual = [(i, f"https://A.example.com:80/{i}", _page(f"<div class='main-{i}'><p>{'story ' * 60}{i}</p></div><div class='extra'><p>short</p></div>")) for i in range(6)]
    odd = (9, "http://user@a.example.com/z", _page(f"<div class='main-9'><p>the story</p></div><div class='extra'><p>{'noise ' * 80}</p></div>"))
    spark.createDataFrame([*usual, odd], PAGE).write.mode("overwrite").parquet(f"{scratch}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in queries.op3_html_extraction(spark, scratch).collect()}
    assert got[9] == "the story"
    assert got[3] == "story " * 60 + "3"


def test_hosts_with_many_paths_keep_all(spark):
    """Forty templates on one host: a page of the least common one still follows its host's vote."""
    name = lambda k: "t" + chr(97 + k // 26) + chr(97 + k % 26)
    story = lambda k, n: f"<section><div class='{name(k)}'><p>{'story ' * n}</p></div></section>"
    rows = [(100 * k + i, "https://h/", _page(story(k, 60 + i))) for k in range(40) for i in range(3 if k else 2)]
    rows.append((9999, "https://h/", _page(f"{story(0, 2)}<div class='extra'><p>{'noise ' * 80}</p></div>")))
    rows.append((9998, "https://other/", _page("<p>only its own</p>")))
    got = {r["page_id"]: r["text"] for r in html_extract.pages_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert len(got) == len(rows) and got[9999] == "story story" and got[9998] == "only its own"
    assert all(got[100 * k + 1] == ("story " * 61).strip() for k in range(40))


def test_edge_pages(spark, scratch):
    rows = [
        (1, None, None), (2, "", ""), (3, "no url", "plain words only"), (4, "https://h/", "<p>unclosed <b>tags <i>here"),
        (5, "https://h/", "<article>" + "<p>para text</p>" * 5000 + "</article>"), (6, "https://h/", "<a href='x>broken quote <p>text</p>"),
        (7, "https://h/", "<script>never closed <p>x"), (8, "https://h/", "< 5 & > 3 <<p>>ok"), (None, "https://h/", "<p>null id</p>"),
        (1, None, None),
    ]
    spark.createDataFrame(rows, PAGE).write.mode("overwrite").parquet(f"{scratch}/pages.parquet")
    got = queries.op3_html_extraction(spark, scratch).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[7]["text"] == ""
    assert by[3]["text"] == "plain words only" and by[None]["text"] == "null id"
    assert by[5]["n_chars"] == len(" ".join(["para text"] * 5000))
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    spark.createDataFrame([], PAGE).write.mode("overwrite").parquet(f"{scratch}/pages.parquet")
    assert queries.op3_html_extraction(spark, scratch).count() == 0


def test_extract_replaces_a_clashing_column(spark):
    df = spark.createDataFrame([(1, "https://h/", "<p>new</p>", "old")], "id long, url string, html string, TEXT string")
    row = html_extract.extract(df).first().asDict()
    assert row["text"] == "new" and "TEXT" not in row and "html" not in row


STORY = "<h1>The old harbour</h1><p>Boats leave at dawn and come back with the tide.</p><p>Nobody counts them any more.</p>"
STORY_TEXT = "The old harbour Boats leave at dawn and come back with the tide. Nobody counts them any more."
LONG_STORY = "".join(f"<p>Paragraph {i} tells how the harbour was built and who paid for it.</p>" for i in range(12))


@pytest.mark.parametrize("body", [
    f"<form id='page-form'><nav><a href=/>home</a></nav><article>{STORY}</article><footer>imprint</footer></form>",
    f"<div class='page-with-sidebar has-comments'><div class='content'>{STORY}</div><div class='sidebar'><p>recent posts</p></div></div>",
    f"<article class='alert-free related'>{STORY}</article>",
    f"<nav><ul><li><a href=/a>first</a><li><a href=/b>second</a></ul><article>{STORY}</article><footer>imprint</footer>",
    f"<div class='modal'><div class='form'><main>{STORY}</main><div class='comments'><p>me too</p></div></div></div>",
])
def test_marks_never_take_the_article(body):
    """Marked wrappers around the whole page are void; marks inside them hold."""
    got = html_extract.text_of(html_extract.parse(f"<html><body>{body}</body></html>"), None)
    assert got == STORY_TEXT


def test_marks_hold_beside_an_article():
    """Comments, notices and forms longer than the article still go."""
    noise = "<p>I could not agree more with every word of this, thank you!</p>" * 14
    for mark in ("<div class='comments'>{}</div>", "<aside>{}</aside>", "<form>{}</form>", "<section id='cookie-notice'>{}</section>"):
        page = f"<html><body><article>{LONG_STORY}</article>{mark.format(noise)}</body></html>"
        got = html_extract.text_of(html_extract.parse(page), None)
        assert got.startswith("Paragraph 0 tells") and got.endswith("who paid for it.") and "agree" not in got
    alone = "<html><body><div class='cookie-banner'><p>We use cookies.</p></div><footer>imprint</footer></body></html>"
    assert html_extract.text_of(html_extract.parse(alone), None) == ""


def test_letters_whose_lower_case_is_longer():
    page = f"<article><p>{chr(0x130) * 40}</p><SCRIPT>var x = '<p>no</p>';</Script ><p>first</p><p>second</p></article>"
    assert html_extract.text_of(html_extract.parse(page), None) == f"{chr(0x130) * 40} first second"
    dotless = f"<p>a</p><script>{chr(0x131)}</scr{chr(0x131)}pt> x</script><p>b</p>"  # only ASCII letters end a tag
    assert html_extract.text_of(html_extract.parse(dotless), None) == "a b"


def test_deep_and_unclosed_tags():
    """Time and memory grow with the page, not with the square of its depth."""
    tracemalloc.start()
    began = time.monotonic()
    deep = html_extract.parse("<div class='level'>" * 50_000 + "<p>the bottom</p>" + "</section>" * 50_000 + "</div>" * 50_000)
    html_extract.votes(deep)
    assert html_extract.text_of(deep, None) == "the bottom"
    raw = html_extract.parse("<p>start</p>" + "<svg>" * 20_000 + "<p>end</p>")
    assert html_extract.text_of(raw, None) == "start end"
    assert tracemalloc.get_traced_memory()[1] < 150e6 and time.monotonic() - began < 60
    tracemalloc.stop()
