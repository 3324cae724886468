"""Golden rows for scalar functions."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates, html, keys, text
from tessera.operators import search
from tessera.operators.normalize import fetch_address


def _apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_iso_date(spark):
    given = ["31.12.2011", "99.99.2011", " 01.02.2003 ", "2003-01-02", "1.2.2003", "", "   ", None, " 01.02.2003"]
    assert _apply(spark, given, dates.iso_date) == ["2011-12-31", "2011-99-99", "2003-02-01", "2003-01-02", "1.2.2003", None, "   ", None, "2003-02-01"]


def test_strip_agrees_with_python(spark):
    given = [" a ", "\x85b\x1c", "\t\n c \r", "", " 　", "d​e", "\x1f x\x1fy \x0b", None]
    assert _apply(spark, given, text.strip) == [x if x is None else x.strip() for x in given]


def test_wait_label(spark):
    assert _apply(spark, [0, 59, 60, 3599, 3600, 7300], text.wait_label, "int") == ["0s", "59s", "1 min", "59 min", "1h", "2h"]


def test_url_quote(spark):
    from urllib.parse import quote

    given = ["a b/c", "ç&=?#~*()'!", "-._", "ığş", "+"]
    assert _apply(spark, [*given, "", None], text.url_quote) == [*map(quote, given), "%20", "%20"]


def test_fetch_address(spark):
    row = spark.range(1).select(fetch_address("https://h", F.lit("1/2 3"), F.lit(None).cast("string")).alias("a")).first()
    assert row["a"] == "https://h/getDokuman?id=1/2%203&arananKelime=%20"


def test_natural_key(spark):
    rows = [("k", "1", "2", None, "u", "k:1:2"), ("k", "1", "", "9", "u", "k:9"), ("k", None, "2", "", "u", "k:u"), ("k", "", "", None, "u", "k:u")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, want string")
    for r in df.select(keys.natural_key(*(F.col(c) for c in "abcde")).alias("got"), "want").collect():
        assert r["got"] == r["want"]
    assert _apply(spark, ["a", "", None], lambda c: keys.message_key(c).cast("string")) == ["a", None, None]


def test_settings_and_addresses(spark):
    got = _apply(spark, ["username=a\npassword=p=q\nusername=b", "nothing", None], text.settings)
    assert got[0] == {"username": "a", "password": "p=q"} and got[1] == {} and got[2] is None
    assert _apply(spark, ["h:90"], lambda c: text.host_port(c)["port"]) == [90]


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p id="hiddencontent">&lt;b&gt;A&lt;/b&gt; &amp;amp; B</p><div id="content">no</div>', "A\n & B"),
        ('<p id="hiddencontent"><b>x</b><i>y</i></p><div id="content"><u>in</u></div>', "in"),
        ('<div><div id="content">a<div>b</div>c</div>d</div>', "a\nb\nc"),
        ("<p>one<br>two</p><script>var x = '</p>';</script><style>p {}</style>three", "one\ntwo\nthree"),
        ("a<!-- no -->b", "a\nb"),
        ("<p title='a > b'>x &#65; &amp &eacute;</p>", "x A & é"),
        ("<p>a\n\n\n\nb</p>", "a\n\nb"),
        ("1 < 2 &amp; 3", "1 < 2 & 3"),
        ("", ""),
        (None, ""),
    ],
)
def test_dom_text(page, want):
    assert html.dom_text(page) == want


def test_page_text_agrees_with_the_dom_walk(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select(html.page_text(F.col("html")).alias("a"), html.dom_text_udf("html").alias("b"))
    assert pages.where("a <> b").count() == 0


def test_keywords_are_whole_words(spark):
    df = spark.createDataFrame([(1, "Vergi davası"), (2, "vergiler"), (3, "vergi, ceza"), (4, None)], "id int, t string")
    ids = lambda **k: [r["id"] for r in df.where(search.keyword_predicate(F.col("t"), **k)).orderBy("id").collect()]
    assert ids(all_of=["vergi"]) == [1, 3]
    assert ids(any_of=["ceza", "davası"]) == [1, 3]
    assert ids(all_of=["vergi"], none_of=["ceza"]) == [1]


def test_search_needs_a_criterion_if_asked():
    with pytest.raises(ValueError):
        search.criteria_predicate(require=True, chamber="")
    with pytest.raises(ValueError):
        search.criteria_predicate(colour="red")


def test_saved_text_by_hand(spark):
    rows = spark.createDataFrame([("5. Daire", "2011/7", "2012/9", "01.02.2012", "body\nend"), (None, None, "1/2", "", "x")], "a string, b string, c string, d string, t string")
    got = [r[0] for r in rows.select(text.header(*(F.col(c) for c in "tabcd"))).collect()]
    rule = "============================================================"
    assert got == [f"Danıştay | 5. Daire | E:2011/7 K:2012/9 T:01.02.2012\n{rule}\nbody\nend\n", f"Danıştay | None | E:None K:1/2 T:\n{rule}\nx\n"]


def test_pages_by_hand(spark):
    many = "<b>x</b>" * 50_000
    pages = [
        ("<p>a&nbsp;b &#39;c&#39; &uuml;</p>", "a\xa0b 'c' ü"),
        ('<div id="content"><p>in</p><script>no</script></div>out', "in"),
        ('<p id="hiddencontent">&lt;i&gt;deep&lt;/i&gt; &amp;amp; on</p><div id="content">no</div>', "deep\n & on"),
        ('<div ID = c&#111;ntent><p>in</p></div>out', "in"),
        ("<style>s</style><p>one</p>\n\n\n\n<p>two</p>", "one\n\ntwo"),
        ("<i>" * 20_000 + "end", "end"),
        (many, "\n".join(["x"] * 50_000)),
        (None, ""),
        ("", ""),
    ]
    frame = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "i int, html string").orderBy("i")
    assert [r[0] for r in frame.select(html.dom_text_udf("html")).collect()] == [t for _, t in pages]
    assert frame.where("i = 6").select(html.page_text(F.col("html"))).first()[0] == pages[6][1]


@pytest.mark.parametrize("page, want", [("<p>a = &quot</p><p>b</p>", 'a = "\nb'), ("<p>&lt</p>", "<"), ("<p>x &quo</p>", "x &quo"), ("<p>x &am</p>", "x &am"), ("<p>&amp</p>", "&")])
def test_entities_that_are_cut_off_at_a_text_s_end(page, want):
    assert html.dom_text(page) == want


def test_words_with_regex_signs(spark):
    rows = spark.createDataFrame([(r"a\Eb (c)",), ("aEb c",)], "t string")
    assert [r[0] for r in rows.select(text.has_words(F.col("t"), [r"a\Eb"])).collect()] == [True, False]


def test_texts_of_white_space_have_no_content(spark):
    rows = [" \u2028\t\x1f", "", "\u3000.", None, "\n" * 1000 + "x"]
    assert _apply(spark, rows, text.has_content) == [False, False, True, None, True]
