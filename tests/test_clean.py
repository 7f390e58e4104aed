"""Cleaning, ordering, enrichment and scoring on small literal tables."""

import random

import pytest
from pyspark.sql import Observation, functions as F

from newsroster.operators import clean, enrich, relevance
from newsroster.operators.ordering import order_by, sort_rows, with_position, with_running_total
from newsroster.plans.process import Rules, process


def links(df):
    return [r["Link"] for r in df.orderBy("ord").collect()]


def test_sort_by_column(mentions):
    df = mentions({"Link": "a", "Date": "2022-01-02"}, {"Link": "b", "Date": "2021-01-01"})
    assert [r["Link"] for r in sort_rows(df, "Date").collect()] == ["b", "a"]


def test_sort_by_unknown_column(mentions):
    with pytest.raises(ValueError):
        sort_rows(mentions({"Link": "a"}), "Missing")
    with pytest.raises(ValueError):
        sort_rows(mentions({"Link": "a"}), ["Link", "Date"], [True])


def test_nulls_last_both_ways(mentions):
    df = mentions({"Date": "x"}, {"Date": None}, {"Date": "b"})
    assert [r["Date"] for r in sort_rows(df, "Date").collect()] == ["b", "x", None]
    assert [r["Date"] for r in sort_rows(df, "Date", False).collect()] == ["x", "b", None]


def test_remove_by_links(mentions):
    df = mentions({"Link": "https://good.com/p"}, {"Link": "https://bad.com/p"},
                  {"Link": "https://badXcom/p"}, {"Link": None})
    # Patterns: the dot matches any character; a null link stays.
    assert links(clean.remove_by_links(df, ["bad.com"])) == ["https://good.com/p", None]
    literal = clean.remove_by_links(df, ["bad.com"], literal=True)
    assert links(literal) == ["https://good.com/p", "https://badXcom/p", None]
    assert len(links(clean.remove_by_links(df, []))) == 4
    many = [f"none{n}" for n in range(450)] + ["good"]
    assert len(links(clean.remove_by_links(df, many))) == 3


def test_dedup_keeps_first_and_one_null(mentions):
    df = mentions({"Link": "a", "Person": "1"}, {"Link": "a", "Person": "2"}, {"Link": None},
                  {"Link": None}, {"Link": "b"})
    rows = clean.dedup_links(df).orderBy("ord").collect()
    assert [(r["Link"], r["ord"]) for r in rows] == [("a", 0), (None, 2), ("b", 4)]


def test_rename_is_not_chained(spark, mentions):
    rules = spark.createDataFrame([("A", "B"), ("B", "C")], "old string, new string")
    df = clean.rename_people(mentions({"Person": "A"}, {"Person": "B"}, {"Person": None}), rules)
    assert [r["Person"] for r in df.orderBy("ord").collect()] == ["B", "C", None]


def rule_list(spark, values, as_table):
    """Rules as a Python list, or the same as a table."""
    return spark.createDataFrame([(v,) for v in values], "rule string") if as_table else values


@pytest.mark.parametrize("as_table", [False, True])
def test_url_filter(spark, mentions, as_table):
    df = mentions(
        *[{"Link": link} for link in (
            "https://good.com/page", "https://bad.com/page", "https://site.com/stopword/page",
            "http://bad.com:8080/x", "https://sub.bad.com/", "http://www.bad.org/", "http://x.bad/",
            "https://site.com/STOPWORD/", None, "https://notbad.com/")])
    rules = [rule_list(spark, values, as_table)
             for values in (["bad.com", "bad", "GOOD.com"], ["stopword", "GOOD"], ["bad.com"])]
    kept = links(clean.url_filter(df, *rules[:2]))
    assert kept == ["https://good.com/page", "https://notbad.com/"]
    # A port belongs to the host, so the plain rule does not match it.
    only = links(clean.drop_blocked_domains(df, rules[2]))
    assert "http://bad.com:8080/x" in only and "https://sub.bad.com/" not in only


def test_stop_words_as_table_equal_brute_force(spark, mentions):
    source = random.Random(3)
    urls = ["http://" + "".join(source.choices("abc/.%$", k=source.randint(0, 14))) for _ in range(300)]
    words = sorted({"".join(source.choices("abc/.%$", k=source.randint(2, 9))) for _ in range(60)})
    df = mentions(*[{"Link": url} for url in urls])
    expected = [u for u in urls if not any(w in u for w in words)]
    assert links(clean.drop_links_with(df, rule_list(spark, words, True))) == expected
    assert links(clean.drop_links_with(df, words)) == expected
    assert links(clean.drop_links_with(df, rule_list(spark, [], True))) == urls
    assert links(clean.drop_links_with(df, rule_list(spark, [""], True))) == []


def test_words_with_one_start_are_not_paired_with_all_links(spark, mentions):
    """All words and links share twenty leading characters; the rarest piece is joined on."""
    n = 400
    df = mentions(*[{"Link": f"https://www.example.com/news/{k:05d}x"} for k in range(n)])
    words = spark.createDataFrame(
        [(f"https://www.example.com/news/{k:05d}z",) for k in range(n)]
        + [("https://www.example.com/news/00007",)], "rule string")
    seen = Observation("joined")
    blocked = clean._links_holding(
        df, words.withColumnRenamed("rule", "__word"), F.lower("Link"), F.lit(True))
    joined = blocked.observe(seen, F.count(F.lit(1)).alias("rows"))
    joined.collect()
    assert seen.get["rows"] <= 2 * n
    assert len(links(clean.drop_links_with(df, words))) == n - 1


def test_patterns_of_a_table(spark, mentions):
    urls = ["http://a.com/x1", "http://b.com/xx", "http://c.com/y", "http://d.com/q?z", None]
    df = mentions(*[{"Link": u} for u in urls])
    patterns = ["a.com", "x+$", "(y|never)$", "nothing.*here", "q[?]z", "^none"]
    table = rule_list(spark, patterns, True)
    assert links(clean.remove_by_links(df, table)) == links(clean.remove_by_links(df, patterns)) == [None]
    literal = spark.createDataFrame([(p,) for p in patterns + ["ab*cd+e", "a*", "."]], "p string").select(
        clean.needed_literal(F.col("p")).alias("w")).collect()
    assert [r.w for r in literal] == ["com", "x", None, "nothing", None, "none", "cd", None, None]


def test_many_patterns(spark, mentions):
    df = mentions({"Link": "http://a.com/w49999"}, {"Link": "http://b.com"})
    many = spark.range(50_000).select(F.concat(F.lit("/w"), F.col("id"), F.lit("$")).alias("rule"))
    assert links(clean.remove_by_links(df, many)) == ["http://b.com"]


def test_long_rule_lists(spark, mentions):
    df = mentions({"Link": "http://r1500.com/"}, {"Link": "http://ok.com/w1500z"}, {"Link": "http://ok.com/"})
    domains = [f"r{n}.com" for n in range(2000)]
    words = [f"w{n}z" for n in range(2000)]
    for as_table in (False, True):
        rules = [rule_list(spark, values, as_table) for values in (domains, words)]
        assert links(clean.url_filter(df, *rules)) == ["http://ok.com/"]


def test_funnel_both_ways(spark, mentions):
    df = mentions({"Link": "http://a.com"}, {"Link": "http://a.com"}, {"Link": None},
                  {"Link": "http://bad.com"}, {"Link": "http://gone.com"})
    expected = [("raw", 5), ("deduplicated", 4), ("links_removed", 3), ("url_filtered", 1)]
    for domains in (["bad.com"], rule_list(spark, ["bad.com", "r.org"], True)):
        rows = clean.funnel(df, domains, [], ["gone"]).orderBy("step_no").collect()
        assert [(r["step"], r["rows"]) for r in rows] == expected


def test_counts_in_passing(mentions):
    df, seen = clean.counted(mentions({"Link": "a"}, {"Link": "b"}), "rows_in")
    assert df.count() == 2 and seen.get == {"rows": 2}


def test_lead_columns(mentions):
    assert clean.lead_columns_first(mentions({})).columns == [
        "Person", "Title", "Date", "Source", "Link", "ord", "Title text"]


def test_positions_and_running_totals(spark):
    source = random.Random(5)
    # One value holds a third of all rows.
    data = [(n, "hot" if n % 3 == 0 else source.choice("abcdef"), source.randint(0, 9))
            for n in range(3000)]
    df = spark.createDataFrame(data, "ord long, k string, v int").repartition(7)
    keys = order_by(["k"], False)
    ordered = sorted(sorted(data), key=lambda r: r[1], reverse=True)
    placed = {r["ord"]: r["rank"] for r in with_position(df, keys).collect()}
    assert placed == {row[0]: at for at, row in enumerate(ordered, 1)}
    totals = {r["ord"]: r["sum"] for r in with_running_total(df, keys, "v", "sum").collect()}
    running, expected = 0, {}
    for row in ordered:
        running += row[2]
        expected[row[0]] = running
    assert totals == expected
    assert with_position(df.where("false"), keys).collect() == []


def test_same_result_for_any_partitioning(spark, mentions):
    df = mentions(*[{"Link": f"l{n % 5}", "Person": str(n)} for n in range(40)])
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(sorted(clean.dedup_links(df.repartition(int(partitions))).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == 5


HTML = "<p>{0}</p><time datetime='2024-05-01'>"


def pages(spark, *rows):
    return spark.createDataFrame(
        [(n, url, html) for n, (url, html) in enumerate(rows)], "page_id long, url string, html string")


def test_fill_blanks(spark, mentions):
    facts = enrich.page_facts(pages(
        spark, ("u1", HTML.format("page")), ("u1", HTML.format("later copy")),
        ("u2", "<article><p>body</p></article>"), ("u3", "<p>" + "x" * 2000 + "</p>")))
    df = mentions(
        {"Link": "u1"}, {"Link": "u1", "Date": "2020-02-02T10:00", "Title text": "kept"},
        {"Link": "u2", "Title text": "overwritten"}, {"Link": "u3"}, {"Link": "unknown"},
        {"Link": None, "Date": "2020-02-02T10:00"}, {"Link": "", "Date": "2020-02-02T10:00"})
    rows = enrich.fill_blanks(df, facts).orderBy("ord").collect()
    assert [(r["Date"], r["Title text"]) for r in rows] == [
        ("2024-05-01", "page"), ("2020-02-02", "kept"), (None, "body"), (None, "x" * 2000),
        (None, None), ("2020-02-02T10:00", None), ("2020-02-02T10:00", None)]
    assert enrich.fill_blanks(df.drop("Title text"), facts).columns[-1] == "Title text"


def test_long_pages_score_by_all_their_words(spark, mentions):
    rows = pages(spark, ("u1", "<article>" + "word " * 2000 + "</article>"), ("u2", "<p>b</p>"))
    filled = enrich.fill_blanks(mentions({"Link": "u1", "Title": "t"}), enrich.page_facts(rows))
    assert relevance.relevance_scores(filled, None, "ord").first()["Relevance"] == 3
    cut = enrich.page_facts(rows, text_limit=9).where("url = 'u1'").first()
    assert cut["article"] == "word word"


def test_article_rules(spark):
    cases = [("word " * 300, None, True), ("short", None, False), ("a\n\nb", "", True), ("a", "Yes", True),
             ("word " * 300, " no", False), ("  ", "Yes", False), (None, "Yes", False)]
    df = spark.createDataFrame([(n, *c[:2]) for n, c in enumerate(cases)], "n int, t string, a string")
    rows = df.select("n", relevance.is_article(F.col("t"), F.col("a"))).orderBy("n").collect()
    assert [r[1] for r in rows] == [c[2] for c in cases]


def test_article_filter_keeps_nulls_and_errors(spark):
    df = spark.createDataFrame(
        [(1, None, "No", False), (2, "x", "No", True), (3, "x", "No", False), (4, "x", "Yes", None)],
        "n int, t string, a string, e boolean")
    assert sorted(r["n"] for r in relevance.keep_articles(df, "t", "a", "e").collect()) == [1, 2, 4]


def test_scores_keep_rows_and_null_title_is_zero(spark, mentions):
    df = mentions({"Title": None, "Title text": "word " * 400}, {"Title": "t", "Title text": "word " * 400},
                  {"Title": "t", "Title text": None}, {"Title": "t", "Title text": "a b"},
                  {"Title": "t", "Title text": "x"})
    replies = spark.createDataFrame([(4, "Score 5", False), (3, "5", True)],
                                    "ord long, answer string, error boolean")
    rows = relevance.relevance_scores(df, replies, "ord").orderBy("ord").collect()
    assert [r["Relevance"] for r in rows] == [0, 3, 0, 0, 5]
    rows = relevance.relevance_scores(df, None, "ord").orderBy("ord").collect()
    assert [r["Relevance"] for r in rows] == [0, 3, 0, 1, 1]


def test_three_kinds_of_scorer_agree(mentions):
    df = mentions({"Title": "t1", "Title text": "irrelevant SPAM here"},
                  {"Title": "t2", "Title text": "a real article body"},
                  {"Title": "t3", "Title text": None})

    def score(person, title, text):
        if title == "t3":
            raise RuntimeError("model down")
        return 0 if "SPAM" in text else 5

    def by_column(person, title, text):
        return F.when(title != "t3", F.when(text.contains("SPAM"), 0).otherwise(5))

    def by_batch(frame):
        known = frame["Title text"].fillna("")
        return known.map(lambda text: 0 if "SPAM" in text or not text else 5)

    expected = [0, 5, 0]
    for scored in (relevance.score_with(df, relevance.arrow_scorer(score)),
                   relevance.score_with(df, by_column), relevance.score_batches(df, by_batch)):
        assert [r["Relevance"] for r in scored.orderBy("ord").collect()] == expected
    kept = relevance.filter_with(df, lambda text: ~text.contains("SPAM"))
    assert kept.count() == 2


def test_process_smoke(spark, mentions):
    people = ["Ada L", "Bo M", "Cy N", "Di O"]
    rows = [{"Person": p, "Title": f"Article about {p}", "Date": "2024-05-01", "Source": "news.example.com",
             "Link": f"https://news.example.com/{p}", "Title text": "Article body"} for p in people]
    df = mentions(*rows, dict(rows[0]),
                  {"Person": "X", "Title": "spam", "Link": "https://bad.com/x", "Title text": "Article spam"},
                  {"Person": "Y", "Title": "dir", "Link": "https://ok.com/listing", "Title text": "phone"})
    renames = spark.createDataFrame([("Ada L", "Ada L (full)")], "old string, new string")
    rules = Rules(["bad.com"], ["listing"], [], renames)
    score = lambda person, title, text: F.when(text.contains("Article"), 4).otherwise(0)
    ranked = process(df, rules, pages(spark, ("none", "")), scorer=score)
    assert ranked.columns[:6] == ["Relevance", "Person", "Title", "Date", "Source", "Link"]
    out = ranked.collect()
    assert [r["Person"] for r in out] == ["Ada L (full)"] + people[1:]
    assert {r["Relevance"] for r in out} == {4}


def test_patterns_with_groups_are_joined_not_collected(spark):
    from newsroster.operators.clean import remove_by_links

    links = ["http://news.example.com/a", "http://blog.example.org/b", "http://promo12.net/x", "http://ads7.io",
             "http://adsx.io", "http://other.com/spam.html", "http://x.com/AbC", None]
    df = spark.createDataFrame([(i, link) for i, link in enumerate(links)], "ord long, Link string")
    patterns = spark.createDataFrame([(r"(news|blog)\.example",), (r"(promo|ads)[0-9]+",), (r"^https?://(www\.)?spam",),
                                      (r"(?i)abc",), (r"[0-9]{9}",)], "pattern string")
    kept = {r["Link"] for r in remove_by_links(df, patterns).collect()}
    import re
    want = {link for link in links if link is None or not any(re.search(p, link) for p in [
        r"(news|blog)\.example", r"(promo|ads)[0-9]+", r"^https?://(www\.)?spam", r"(?i)abc", r"[0-9]{9}"])}
    assert kept == want == {"http://adsx.io", "http://other.com/spam.html", None}
