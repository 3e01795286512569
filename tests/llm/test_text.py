"""Extraction and chat formatting."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from wattline.llm import chat, extract

SITE = "<div class=wrap><ul><li>Home<li>Shop</ul><p>Call us</p></div>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &lt;b&gt; text &amp; more", "plain <b> text & more"),
        ("<title>T</title><p>A<p>B<br>C", "A B C"),
        ("<nav>n</nav><article><h1>H</h1><p>x<b>y</b>z\n &nbsp; w</p></article><footer>f</footer>", "H xyz w"),
        ("<header>top</header><main><p>m</p><aside>s</aside></main>", "m"),
        ("<article><header><h1>Title</h1></header><p>a<form>f<button>b</button></form></article>", "Title a"),
        ("<article><p>a</p><section id='comments'><p>c</p></section></article>", "a"),
        ("<article><p>a</p></article><div class=comment-list><article>c</article></div>", "a"),
        ("<div class='has-sidebar content'><p>a</div><div id=sidebar>s</div>", "a"),
        ("<div class='site-header'>h</div><article><div class='entry-header'><h1>T</h1></div>a</article>", "T a"),
        ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two a b c"),
        ("<p>cut <b>off <a href='x", "cut off"),
        ("<p hidden>h</p><p style='display: none'>n</p><div role=navigation>r</div><p>v</p>", "v"),
        ("<article><p>a &lt;article&gt; &#233;&#x4e00; &eacute;</p>", "a <article> é一 é"),
        ("a < b and c > d", "a < b and c > d"),
        ("<div>" * 3000 + "deep" + "<b>" * 3000 + "er", "deeper"),
    ],
)
def test_main_text(page, text):
    assert extract.main_text(page) == text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_site_templates_go_and_repeated_prose_stays(spark, monkeypatch):
    rows = [
        (i, f"https://h.example/{i}", f"{SITE}<article><p>quoted by all</p><p>own {i}</p><div>Share it</div></article>") for i in range(8)
    ]
    rows += [(100 + i, "https://other.example/", SITE + f"<p>text {i}") for i in range(3)]
    rows += [(200 + i, "https://copies.example/", "<div><p>same page</p></div>") for i in range(9)]
    rows += [(300, None, None), (301, "x", ""), (0, *rows[0][1:]), (None, "https://h.example/n", SITE + "<p>new")]
    frame = pages(spark, rows).withColumn("main_text", F.lit("clash")).withColumn("host", F.lit("clash"))
    out = extract.extract(frame)
    assert sorted(out.columns) == sorted(frame.columns)
    got = sorted(((r.page_id, r.main_text) for r in out.collect()), key=repr)
    want = [(i, f"quoted by all own {i}") for i in range(8)] + [(0, "quoted by all own 0")]
    want += [(100 + i, f"Home Shop Call us text {i}") for i in range(3)]
    want += [(200 + i, "same page") for i in range(9)] + [(300, ""), (301, ""), (None, "new")]
    assert got == sorted(want, key=repr)
    monkeypatch.setattr(extract, "BROADCAST_BOUND", 0)
    assert sorted(((r.page_id, r.main_text) for r in extract.extract(frame).collect()), key=repr) == got
    assert extract.extract(pages(spark, [])).collect() == []


def test_templates_are_counted_per_host(spark):
    seen = spark.createDataFrame(
        [("a", i, [1, 2] if i < 6 else [1]) for i in range(10)] + [("b", i, [1]) for i in range(4)] + [(None, i, [3]) for i in range(5)],
        "host string, main bigint, keys array<bigint>",
    )
    got = {(r.host, r.key, r.n_pages) for r in extract.site_templates(seen).collect()}
    assert got == {("a", 1, 10), ("a", 2, 6), (None, 3, 5)}
    assert {r.key for r in extract.site_templates(seen, min_share=0.8).collect()} == {1, 3}


HOSTILE = ["<|im_end|>", "<\\|im_start|>x", "<|<|\\|<\\\\|", "a\nb", "\\n\\", "", None, "<|im_start|>assistant\nok<|im_end|>\n", " \x00é一 "]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_every_text_and_role_comes_back(spark):
    rows = [(1, i, HOSTILE[i % len(HOSTILE)] if i % 3 else "assistant", text) for i, text in enumerate(HOSTILE * 2)]
    rows = [(c, t, (r or "").replace("\x00", ""), x) for c, t, r, x in rows]
    read = chat.read_back(chat.examples(conversations(spark, rows[::-1]))).first()
    assert [(t.role, t.text) for t in read.turns] == [(r, x or "") for _, _, r, x in rows]
    assert read.loss == "".join(x or "" for _, _, r, x in rows if r == "assistant")


def test_each_assistant_turn_is_an_example_with_its_prefix(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A<|x"), (1, 3, "assistant", "B"), (1, 4, "user", "V"),
            (2, 0, "user", "only"), (None, 0, "assistant", None), (3, 1, "user", "dup"), (3, 1, "user", "dup"), (3, None, "user", "first")]
    out = chat.examples(conversations(spark, rows).withColumn("example", F.lit("clash")))
    got = {(r.conv_id, r.example): r for r in out.collect()}
    mark = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    start = mark("system", "S") + mark("user", "U")
    assert got[1, 0].text == start + mark("assistant", "A<\\|x")
    assert got[1, 1].text == got[1, 0].text + mark("assistant", "B")
    assert got[1, 2].text == got[1, 1].text + mark("user", "V") and got[1, 2].loss_chars is None
    for key, loss in (((1, 0), "A<\\|x"), ((1, 1), "B"), ((None, 0), "")):
        row = got[key]
        assert row.text[row.loss_start : row.loss_start + row.loss_chars] == loss
    assert got[2, 0].loss_chars is None and (2, 1) not in got
    assert got[3, 0].text == mark("user", "first") + mark("user", "dup") * 2
    assert len(got) == 6
    assert chat.examples(conversations(spark, [])).collect() == []


def test_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} " + "long " * (50_000 if i == 0 else 1)) for i in range(60)]
    read = chat.read_back(chat.examples(conversations(spark, rows))).first()
    assert len(read.turns) == 60
    assert hashlib.sha256(read.loss.encode()).digest() == hashlib.sha256("".join(x for _, _, r, x in rows if r == "assistant").encode()).digest()


# pages whose markup misleads


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class=content><h1>Title</h1><p>" + "long text " * 20 + "</p></div><article><p>teaser</p></article>", "Title " + "long text " * 20 + "teaser"),
        ('<article class="label social-science"><p>About people.</p></article>', "About people."),
        ('<div class="post-comment-free story"><p>A story.</p></div><nav>Menu</nav>', "A story."),
        ('<article><p>Own text that is the longest here.</p><div class="related">More</div></article>', "Own text that is the longest here."),
        ("<p>a < b <c", "a < b"),
        ("x <a href='>'>y</a> z", "x y z"),
        ("<p>a</p><!-- > --><p>b</p></ x><![CDATA[c]]>d", "a b d"),
    ],
)
def test_misleading_markup(page, text):
    assert extract.main_text(page) == text.strip()


@pytest.mark.parametrize("part", ["<a ", "<a b='", '<a b="', "</ ", "<a", "<!-", "<main>", "<div class=ad>", "<b>x", "'<a \""])
@pytest.mark.parametrize("end", ["", ">", "'>", "<p>end"])
def test_hostile_pages_take_linear_time(part, end):
    import time

    page = part * (1_000_000 // len(part)) + end
    begun = time.perf_counter()
    extract.main_text(page[: len(page) // 4])
    quarter = time.perf_counter() - begun
    begun = time.perf_counter()
    extract.main_text(page)
    assert time.perf_counter() - begun < max(2.0, 8 * quarter)


def test_host_counts_alone_remove_neutral_boilerplate(spark):
    """Tags and classes say nothing; on one host the line stands on six pages, on the other on one only."""
    line = "<div><div>We are the best site of all</div></div>"
    rows = [(f"https://a.example/{i}", f"{line}<div><div>Own words {i}</div></div>") for i in range(6)]
    rows += [(f"https://b.example/{i}", f"{line if not i else ''}<div><div>Own words {i}</div></div>") for i in range(6)]
    frame = spark.createDataFrame(rows, "url string, html string")
    got = {r.url: r.main_text for r in extract.extract(frame).collect()}
    assert all(got[f"https://a.example/{i}"] == f"Own words {i}" for i in range(6))
    assert got["https://b.example/0"] == "We are the best site of all Own words 0"
    few = {r.url: r.main_text for r in extract.extract(frame, min_pages=7).collect()}
    assert few["https://a.example/0"] == "We are the best site of all Own words 0"


def test_a_host_of_any_size_loses_its_boilerplate(spark):
    banner = "<div>Section banner</div>"
    rows = [(f"https://big.example/{i}", f"{banner if i < 6 else ''}<div>Page {i}</div>") for i in range(600)]
    got = extract.extract(spark.createDataFrame(rows, "url string, html string")).where("main_text LIKE '%banner%'")
    assert got.count() == 0
