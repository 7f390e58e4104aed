"""Article decision and relevance scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import text as X
from ..functions.text import WHITESPACE
from ..operators import relevance as R
from .landed import Landed, oracle

ARTICLE_TEMPLATE = "Is this an article?\n{text}\nSignals: {context}"
RELEVANCE_TEMPLATE = "Person: {person}\nTitle: {title}\nText: {text}\nScore 0-5:"


def _judged(landed):
    return landed.texts.join(landed.answers, "doc_id", "left")


def text_features(spark, folder):
    rows = Landed(spark, folder).paragraphs
    return rows.select("doc_id", R.text_features(F.col("text")).alias("f")).select(
        "doc_id", F.col("f.words").cast("long").alias("words"),
        F.col("f.paragraphs").cast("long").alias("paragraphs"), "f.has_date", "f.has_byline")


def article_prompt(spark, folder):
    return Landed(spark, folder).paragraphs.select(
        "doc_id", R.article_prompt(F.col("text"), ARTICLE_TEMPLATE).alias("prompt"))


def relevance_prompt(spark, folder):
    return Landed(spark, folder).texts.select("doc_id", R.relevance_prompt(
        F.col("person"), F.col("title"), F.col("title_text"), RELEVANCE_TEMPLATE).alias("prompt"))


def is_article(spark, folder):
    return _judged(Landed(spark, folder)).select(
        "doc_id", R.is_article(F.col("title_text"), F.col("yes_no")).alias("article"))


def article_filter(spark, folder):
    rows = _judged(Landed(spark, folder))
    return R.keep_articles(rows, "title_text", "yes_no", "error").select("doc_id", "person")


def parse_score(spark, folder):
    return Landed(spark, folder).answers.select(
        "doc_id", A.parse_score(F.col("answer")).alias("score"))


def length_score(spark, folder):
    words = X.word_count(F.col("title_text"))
    return Landed(spark, folder).texts.select("doc_id", words.alias("words")).select(
        "doc_id", R.fallback_score(F.col("words")).alias("score"))


def relevance_scores(spark, folder):
    landed = Landed(spark, folder)
    rows = landed.texts.withColumnRenamed("title", "Title")
    replies = landed.answers.select("doc_id", "answer", "error")
    return R.relevance_scores(rows, replies, "doc_id", "title_text").select(
        "doc_id", "Title", F.col("Relevance").alias("score"))


def answer_text(spark, folder):
    """Eight response shapes around whole documents."""
    said = F.col("text")
    one = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    bodies = [
        F.to_json(one(response=said)),
        F.to_json(one(results=F.array(one(content=F.lit("  "), text=F.lit("")),
                                      one(content=F.lit(" "), text=said)))),
        F.to_json(one(choices=F.array(
            one(content=F.array(one(text=F.lit(None).cast("string"), kind=F.lit("x")))),
            one(content=F.array(one(text=F.lit(None).cast("string"), kind=F.lit("y")),
                                one(text=said, kind=F.lit("z"))))))),
        F.to_json(one(results=F.array().cast("array<string>"), choices=F.array(one(output=said)))),
        F.to_json(one(output=said)),
        said,
        F.lit('{"response":5,"done":true}'),
        F.to_json(one(results=F.lit("x"), choices=F.array(one(output=F.lit("no"))), output=said))]
    shape = F.col("doc_id") % len(bodies)
    body = F.when(shape == 0, bodies[0])
    for number, candidate in enumerate(bodies[1:], 1):
        body = body.when(shape == number, candidate)
    return Landed(spark, folder).documents.select("doc_id", A.answer_text(body).alias("answer"))


def chat_answer_text(spark, folder):
    rows = Landed(spark, folder).conversations
    body = F.to_json(F.struct(F.array(F.struct(F.struct(
        F.col("role"), F.col("text").alias("content")).alias("message"))).alias("choices")))
    return rows.select("conv_id", "turn", A.chat_answer_text(body).alias("answer"))


def custom_scorer(spark, folder):
    """A Python scoring function over whole texts, in Arrow batches."""
    def score(person: str, title: str, text: str) -> int:
        if "que" in text:
            return 5
        return 0 if "the" in text else 3

    rows = Landed(spark, folder).texts.select(
        "doc_id", F.col("person").alias("Person"), F.col("title").alias("Title"), "title_text")
    return R.score_with(rows, R.arrow_scorer(score), "title_text").select(
        "doc_id", F.col("Relevance").alias("score"))


def column_scorer(spark, folder):
    """The same scorer as a column expression."""
    def score(person, title, text):
        return F.when(text.contains("que"), 5).when(text.contains("the"), 0).otherwise(3)

    rows = Landed(spark, folder).texts.select(
        "doc_id", F.col("person").alias("Person"), F.col("title").alias("Title"), "title_text")
    return R.score_with(rows, score, "title_text").select(
        "doc_id", F.col("Relevance").alias("score"))


QUERIES = {
    "text_features": text_features, "article_prompt": article_prompt,
    "relevance_prompt": relevance_prompt, "is_article": is_article,
    "article_filter": article_filter, "parse_score": parse_score, "length_score": length_score,
    "relevance_scores": relevance_scores, "answer_text": answer_text,
    "chat_answer_text": chat_answer_text, "custom_scorer": custom_scorer,
    "column_scorer": column_scorer,
}


def sql_words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{WHITESPACE}]+'))"


def sql_paragraphs(text: str) -> str:
    return f"len(string_split({text}, chr(10) || chr(10)))"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g')"


def sql_length_score(text: str) -> str:
    words = sql_words(f"coalesce({text}, '')")
    return (f"CAST(CASE WHEN {words} >= 300 THEN 3 WHEN {words} >= 100 THEN 2 "
            f"WHEN {words} > 0 THEN 1 ELSE 0 END AS INT)")


def sql_score(answer: str) -> str:
    return f"TRY_CAST(regexp_extract({answer}, '[0-5]') AS INT)"


_HAS_DATE = ("(contains(text, 'Published') OR contains(text, 'published') OR contains(text, '©') "
             "OR contains(text, '20') OR contains(text, '19'))")
_HAS_BYLINE = "(contains(text, 'By ') OR contains(text, 'by '))"
_ARTICLE = f"""
    CASE WHEN title_text IS NULL OR {sql_words('title_text')} = 0 THEN false
         WHEN coalesce(yes_no, '') <> '' THEN starts_with(lower({sql_strip('yes_no')}), 'y')
         ELSE {sql_words('title_text')} >= 200 OR {sql_paragraphs('title_text')} >= 2 END"""
_JUDGED = "{texts} t LEFT JOIN {answers} a ON a.doc_id = t.doc_id"
_SCORER = """
    SELECT doc_id, CAST(CASE WHEN contains(coalesce(title_text, ''), 'que') THEN 5
                             WHEN contains(coalesce(title_text, ''), 'the') THEN 0 ELSE 3 END AS INT) AS score
    FROM {texts}"""

ORACLE = {
    "text_features": oracle(f"""
        SELECT doc_id, {sql_words('text')} AS words, {sql_paragraphs('text')} AS paragraphs,
               {_HAS_DATE} AS has_date, {_HAS_BYLINE} AS has_byline FROM {{paragraphs}}"""),
    "article_prompt": oracle(f"""
        SELECT doc_id, 'Is this an article?' || chr(10) || text || chr(10)
               || 'Signals: Words: ' || {sql_words('text')} || '; Paragraphs: '
               || {sql_paragraphs('text')} || '; HasDate: '
               || CASE WHEN {_HAS_DATE} THEN 'True' ELSE 'False' END || '; HasByline: '
               || CASE WHEN {_HAS_BYLINE} THEN 'True' ELSE 'False' END || '.' AS prompt
        FROM {{paragraphs}}"""),
    "relevance_prompt": oracle(f"""
        SELECT doc_id, 'Person: ' || person || chr(10) || 'Title: ' || coalesce(title, '') || chr(10)
               || 'Text: ' || coalesce(nullif({sql_strip("coalesce(title_text, '')")}, ''),
                                       '(no text extracted)')
               || chr(10) || 'Score 0-5:' AS prompt
        FROM {{texts}}"""),
    "is_article": oracle(f"SELECT t.doc_id, {_ARTICLE} AS article FROM {_JUDGED}"),
    "article_filter": oracle(f"""
        SELECT t.doc_id, person FROM {_JUDGED}
        WHERE title_text IS NULL OR {_ARTICLE} OR coalesce(error, false)"""),
    "parse_score": oracle(f"SELECT doc_id, {sql_score('answer')} AS score FROM {{answers}}"),
    "length_score": oracle(f"SELECT doc_id, {sql_length_score('title_text')} AS score FROM {{texts}}"),
    "relevance_scores": oracle(f"""
        SELECT t.doc_id, title AS Title,
               CASE WHEN title IS NULL OR coalesce(error, false) THEN 0
                    ELSE coalesce({sql_score('answer')}, {sql_length_score('title_text')}) END AS score
        FROM {_JUDGED}"""),
    "answer_text": f"""
        SELECT doc_id, CASE WHEN doc_id % 8 = 6 THEN '{{"response":5,"done":true}}'
                            ELSE {sql_strip('text')} END AS answer FROM documents""",
    "chat_answer_text": f"SELECT conv_id, turn, {sql_strip('text')} AS answer FROM conversations",
    "custom_scorer": oracle(_SCORER), "column_scorer": oracle(_SCORER),
}
