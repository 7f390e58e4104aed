"""Column functions against plain Python."""

from datetime import datetime
from urllib.parse import quote, unquote, urlparse

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsroster.functions import answers, dates, html, text, urls

BATCH = settings(max_examples=6, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])
SPACES = text.NARROW_SPACES + text.WIDE_SPACES
WORDY = st.text(alphabet="ab—é日​😀" + SPACES, max_size=30)


def column(spark, values, expression):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r[1] for r in sorted(rows.select("n", expression(F.col("v"))).collect())]


def test_space_list_is_pythons():
    import sys
    assert sorted(SPACES) == [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]


@BATCH
@given(st.lists(WORDY, min_size=100, max_size=200))
def test_whitespace_rules(spark, values):
    assert column(spark, values, text.word_count) == [len(v.split()) for v in values]
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert column(spark, values, text.collapse) == [" ".join(v.split()) for v in values]
    assert column(spark, values, text.is_blank) == [not v.strip() for v in values]


@BATCH
@given(st.lists(st.text(alphabet="a\n", max_size=12), min_size=50, max_size=100))
def test_paragraphs(spark, values):
    assert column(spark, values, text.paragraph_count) == [v.count("\n\n") + 1 for v in values]


@BATCH
@given(st.lists(st.one_of(
    st.text(max_size=10).map(quote), st.text(alphabet="a+%2Z0éO ", max_size=12)),
    min_size=100, max_size=200))
def test_unquote(spark, values):
    values = [v for v in values if not any(0xD800 <= ord(c) <= 0xDFFF for c in v)]
    assert column(spark, values, text.unquote) == [unquote(v) for v in values]


def _compact(value):
    value = value.strip()
    try:
        if "-" in value:
            return datetime.strptime(value, "%Y-%m-%d").strftime("%Y%m%d").zfill(8)
        if len(value) == 8 and value.isdigit():
            return datetime.strptime(value, "%Y%m%d").strftime("%Y%m%d").zfill(8)
    except ValueError:
        pass
    return None


@BATCH
@given(st.lists(st.one_of(
    st.dates().map(str), st.dates().map(lambda d: str(d).replace("-", "")),
    st.tuples(st.integers(1900, 2100), st.integers(0, 14), st.integers(0, 33)).map(
        lambda t: " {}-{}-{} ".format(*t)),
    st.text(alphabet="0123456789-", max_size=10)), min_size=100, max_size=200))
def test_compact_date(spark, values):
    assert column(spark, values, dates.compact_date) == [_compact(v) for v in values]


URLS = [
    " https://bad.com/x", "\x01\thttps://bad.com/x", "http://ba\td.co\nm:8/x", " //x.y","http://www.bad.com:8080/x", "https://user@Host.org/a?b#c", "HTTP://WWW.X.COM", "host/x",
        "//cdn.net/y", "", "mailto:x@y", "https://a_b.com/ q", "ftp://f.org?x", "http://h.org#f"]


def test_netloc(spark):
    assert column(spark, URLS, urls.netloc) == [urlparse(u).netloc for u in URLS]
    hosts = [urlparse(u.lower()).netloc for u in URLS]
    assert column(spark, URLS, urls.domain) == [h.removeprefix("www.") for h in hosts]


LABELS = st.lists(st.sampled_from(["a", "b", "com", "", "c:80"]), min_size=1, max_size=4).map(".".join)


@BATCH
@given(st.lists(LABELS, min_size=30, max_size=60), st.lists(LABELS, min_size=1, max_size=5))
def test_domain_rules_both_ways(spark, hosts, rules):
    expected = [any(h == r or h.endswith("." + r) or h.startswith(r + ".") for r in rules)
                for h in hosts]
    assert column(spark, hosts, lambda c: urls.matches_domain(c, rules)) == expected
    keyed = column(spark, hosts, urls.domain_keys)
    assert [bool(set(keys) & set(rules)) for keys in keyed] == expected


@BATCH
@given(st.lists(st.text(alphabet="ab.|", max_size=6), min_size=1, max_size=40),
       st.lists(st.text(alphabet="ab.|", max_size=9), min_size=50, max_size=50))
def test_any_of(spark, words, values):
    words = sorted(set(words))
    found = column(spark, values, lambda c: c.rlike("^" + text.any_of(words) + r"\z"))
    assert found == [v in words for v in values]


def test_fill_template_keeps_braces(spark):
    made = column(spark, ["x"], lambda c: text.fill_template("{{a}} {v}!", v=c))
    assert made == ["{a} x!"]


PAGE = """<html><head><title>T</title><script>var t="</p>"</script></head><body><!-- no --><nav>menu</nav>
<article><h1>Head</h1><p>One &amp; two<br>three</p><p> </p><p>Four&nbsp;five</p></article><footer>&copy; x</footer>"""


def test_page_text_and_article(spark):
    assert column(spark, [PAGE], html.page_text) == [
        "Tmenu HeadOne & twothree Four five© x"]
    assert column(spark, [PAGE, PAGE.replace("article>", "main>"), "<p>x</p>"],
                  html.article_body) == [
        "Head\n\nOne & two\n\nthree\n\nFour five"] * 2 + [None]


def test_every_article_counts(spark):
    two = "<article><p>a</p></article><nav>menu</nav><article>b</article><main>m</main>"
    assert column(spark, [two], html.article_body) == ["a\n\nb"]


def test_publish_date_cascade(spark):
    meta = '<meta property="article:published_time" content="2024-05-01T10:00:00Z">'
    turned = '<META content="2024-05-02" name="datePublished">'
    linked = '<script>{"datePublished" : "2024-05-03T00:00"}</script>'
    timed = '<time class="d" datetime="2024-05-04">'
    bad = '<meta property="article:published_time" content="soon">'
    cases = [meta + linked, turned + timed, linked + timed, timed, bad, bad + timed]
    found = column(spark, cases, lambda c: html.publish_date(c, F.lit("http://x/2024/05/05/a")))
    assert found == ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04", "2024-05-05",
                     "2024-05-04"]
    assert column(spark, [""], lambda c: html.publish_date(c, F.lit("http://x/2024/02/30/a"))) == [None]


def test_answer_shapes(spark):
    cases = {
        '{"response": " Yes "}': "Yes", '{"response": "  "}': "", '{"response": 5}': '{"response": 5}',
        '{"results": [{"content": " "}, {"text": "4"}]}': "4",
        '{"choices": [{"message": {"content": "no"}}, {"output": "x"}]}': "x",
        '{"results": [], "choices": [{"content": [{"kind": 1}, {"text": 3}]}]}': "3",
        '{"text": "t", "output": "o"}': "o", "[1]": "[1]", " plain ": "plain",
        '{"results": "no list", "content": "c"}': "c",
        '{"results": "x", "choices": [{"text": "no"}], "output": "o"}': "o",
        '{"results": 0, "choices": [{"text": "yes"}]}': "yes",  '"quoted"': '"quoted"'}
    assert column(spark, list(cases), answers.answer_text) == list(cases.values())
    chat = '{"choices": [{"message": {"content": " 5 "}}]}'
    assert column(spark, [chat], answers.chat_answer_text) == ["5"]


def test_scores(spark):
    said = ["Score: 4", "10", "9 of 7, so 2", "none", "", "-3"]
    assert column(spark, said, answers.parse_score) == [4, 1, 2, None, None, 3]
    assert column(spark, [" Yes.", "yep", "No", ""], answers.says_yes) == [True, True, False, False]


def test_nested_articles_stay_inside_their_outer_one(spark):
    from newsroster.functions.html import article_body

    cases = {"<article>a<article>b</article>c</article>": "abc",
             "<article>one</article><div>y</div><article>two</article>": "one\n\ntwo",
             "</article><article>k</article>": "k", "<article>open only": None,
             "<ARTICLE id=1>A<article >B</article>C</ARTICLE>": "ABC", "<main>m<main>n</main>o</main>": "mno",
             "<article></article><main>z</main>": "z"}
    df = spark.createDataFrame(list(cases), "string").toDF("html")
    got = {r.html: r.a for r in df.select("html", article_body(df.html).alias("a")).collect()}
    assert got == cases
