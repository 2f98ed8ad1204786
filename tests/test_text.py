import pytest
from pyspark.sql import functions as F

from tamarack.functions import html as hx
from tamarack.functions import text as tx


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column("t")).first()[0]


@pytest.mark.parametrize(
    "text, want",
    [
        ("It's a well-known fact, U.S.", ["Its", "a", "wellknown", "fact", "US"]),
        (" \t\n", []),
        ("Democrats’ plan now", ["Democrats", "’", "plan", "now"]),
        ("The the THE", ["The", "the", "THE"]),
    ],
)
def test_strip_tokens(spark, text, want):
    assert one(spark, text, tx.tokenize_words) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Well, it's 3,000 at 10:30: ok.", ["Well", ",", "it's", "3,000", "at", "10:30", ":", "ok", "."]),
        ("(a) b%%% c...d -- e?", ["(", "a", ")", "b", "%", "%", "%", "c", "...", "d", "--", "e", "?"]),
        ("e.g. x", ["e.g", ".", "x"]),
    ],
)
def test_punctuation_tokens(spark, text, want):
    assert one(spark, text, lambda c: tx.tokenize_words(c, "keep_punct")) == want


def test_unknown_mode():
    with pytest.raises(ValueError):
        tx.tokenize_words(F.lit("x"), "other")


@pytest.mark.parametrize(
    "text, n, want",
    [("a b c", 2, ["a b", "b c"]), ("a", 2, []), ("a  b", 2, ["a ", " b"]), ("a b c d", 3, ["a b c", "b c d"])],
)
def test_word_ngrams(spark, text, n, want):
    assert one(spark, text, lambda c: tx.word_ngrams(c, n)) == want


def test_fingerprints(spark):
    assert one(spark, "single", tx.fingerprint_ngram_word) == ""
    assert one(spark, "b a b a", tx.fingerprint_ngram_word) == "a bb a"
    keys = [one(spark, x, tx.fingerprint_ngram_char) for x in ("Café Noir", " café-noir", "CAFÉ\u0007NOIR")]
    assert set(keys) == {"afcafeirnooien"}  # grams sorted with é, then folded
    assert one(spark, "paris", tx.fingerprint_ngram_char) == "arispari"


@pytest.mark.parametrize(
    "text, want", [("12", True), (" -1.5e3 ", True), (".5", True), ("1d", False), ("", False), ("1.2.3", False)]
)
def test_numeric(spark, text, want):
    assert one(spark, text, tx.is_numeric) is want


def test_white_space(spark):
    assert one(spark, "\t a   b\n", tx.trim_text) == "a   b"
    assert one(spark, "\t a   b\n", tx.squash_whitespace) == "a b"
    assert one(spark, "a\u0000​b", tx.strip_control_chars) == "ab"


def test_split_columns(spark):
    df = spark.createDataFrame([("a b",), ("a",), ("a b c d",)], "t string")
    got = [tuple(r) for r in df.select(*tx.split_columns("t", ["x", "y"])).collect()]
    assert got == [("a", "b", None), ("a", None, None), ("a", "b", "c d")]


def test_dates(spark):
    assert str(one(spark, "Jan 5, 2024", tx.parse_date_text)) == "2024-01-05"
    assert one(spark, "someday", tx.parse_date_text) is None


PAGE = """<html><!-- <p>no</p> <a href="no">x</a> --><script>var t="</p><p>no";</script>
<STYLE>p{}</STYLE><body><nav><A class=x href='/a.html'>A</A><a name="n">x</a></nav>
<p>One <b>bold</b><p class="k">Two &amp; &#233;&#x4E2D; &lt;b&gt; &nope; &nbsp;</P>
<div>outside</div><p></p><p>Three<ul><li>not in a paragraph</ul></body></html>"""


def test_paragraphs(spark):
    got = one(spark, PAGE, hx.html_paragraphs)
    assert [x.strip() for x in got] == ["One bold", "Two & é中 <b> &nope;", "", "Three"]
    assert one(spark, PAGE, hx.page_text) == "One bold Two & é中 <b> &nope; Three"


def test_links(spark):
    assert one(spark, PAGE, hx.html_links) == ["/a.html"]
    odd = """<a data-href="x" href="y">1</a><a class=c href=z>2</a><a title='href="no"' HREF = '/q?a=1&amp;b=2'>3</a>
        <abbr href="no">4</abbr><a
        href="">5</a><a hrefx="no">6</a><area href="no">"""
    assert one(spark, odd, hx.html_links) == ["y", "z", "/q?a=1&b=2", ""]
    for href, want in [
        ("/x", "https://h.example/x"),
        ("x", "https://h.example/x"),
        ("http://o.example/", "http://o.example/"),
        ("mailto:a@b", "mailto:a@b"),
    ]:
        assert one(spark, href, lambda c: hx.resolve_link(F.lit("https://h.example/p/q?z"), c)) == want


def test_odd_references(spark):
    assert one(spark, "&#0; &#55296; &#9999999; a&b", hx.unescape_entities) == "&#0; &#55296; &#9999999; a&b"
    assert one(spark, None, hx.unescape_entities) is None


REFERENCES = [
    "it&apos;s &copy 2020 &#150; &NotEqual;", "&notit; &notin; &ampx &ltb&gt", "&#x80;&#159 &#xE9;&#233;&eacute",
    "&NotEqualTilde; &copyright", "&hellip;&hellip", "a & b && &; &;amp", "&AMP;&QUOT&AElig;", "&frac12&frac14;", "&#38;amp;",
]


def test_references_as_the_standard_parser_reads_them(spark):
    from html import unescape

    for text in REFERENCES:
        assert one(spark, text, hx.unescape_entities) == unescape(text)


def test_references_in_attributes(spark):
    page = "<a href='/q?a=1&copy=2&copyx=3&copy;=4&amp;b=5&lt'>x</a>"
    assert one(spark, page, hx.html_links) == ["/q?a=1&copy=2&copyx=3©=4&b=5<"]


def test_numbers_of_no_character_stay(spark):
    assert one(spark, "&#99999999999999999999999; &#x110000; &#xD800; &#;", hx.unescape_entities) == (
        "&#99999999999999999999999; &#x110000; &#xD800; &#;"
    )
