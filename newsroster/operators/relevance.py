"""Article decision and relevance score from model answers, with rules where there is none."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import answers as A
from ..functions import text as X
from .enrich import cut_text

# Signals of the feature summary, and the thresholds of the rules.
DATE_TOKENS = ["Published", "published", "©", "20", "19"]
BYLINE_TOKENS = ["By ", "by "]
ARTICLE_WORDS, ARTICLE_PARAGRAPHS = 200, 2
LENGTH_STEPS = [1, 100, 300]
NO_PERSON, NO_TEXT = "(unknown)", "(no text extracted)"


def text_features(text: Column) -> Column:
    """Struct (words, paragraphs, has_date, has_byline)."""
    return F.struct(
        X.word_count(text).alias("words"), X.paragraph_count(text).alias("paragraphs"),
        X.contains_any(text, DATE_TOKENS).alias("has_date"),
        X.contains_any(text, BYLINE_TOKENS).alias("has_byline"))


def feature_summary(text: Column) -> Column:
    """The features as the one-line context of an article prompt."""
    features = text_features(text)

    def flag(name: str) -> Column:
        return F.when(features[name], "True").otherwise("False")

    # Fixed value: the form of the line.
    return X.fill_template(
        "Words: {words}; Paragraphs: {paragraphs}; HasDate: {date}; HasByline: {byline}.",
        words=features["words"].cast("string"), paragraphs=features["paragraphs"].cast("string"),
        date=flag("has_date"), byline=flag("has_byline"))


def article_prompt(text: Column, template: str, text_limit: int | None = None) -> Column:
    """The user's template with ``{text}`` and ``{context}`` filled in.

    ``text_limit``: characters of the text that fit the prompt of the caller's model; the whole
    text by default. The context always describes the whole text.
    """
    return X.fill_template(
        template, text=cut_text(text, text_limit), context=feature_summary(text))


def relevance_prompt(
    person: Column, title: Column, text: Column, template: str,
    text_limit: int | None = None, title_limit: int | None = None,
) -> Column:
    """The user's template with ``{person}``, ``{title}`` and ``{text}`` filled in; whole by
    default, cut where the caller's model takes so many characters only."""
    body = X.strip(F.coalesce(text, F.lit("")))
    return X.fill_template(
        template,
        person=F.coalesce(F.nullif(person, F.lit("")), F.lit(NO_PERSON)),
        title=cut_text(F.coalesce(title, F.lit("")), title_limit),
        text=F.coalesce(F.nullif(cut_text(body, text_limit), F.lit("")), F.lit(NO_TEXT)))


def is_article(text: Column, answer: Column) -> Column:
    """Blank text is none; an answer decides by its first letter; without one the length does."""
    long_enough = (
        (X.word_count(text) >= ARTICLE_WORDS) | (X.paragraph_count(text) >= ARTICLE_PARAGRAPHS))
    return (
        F.when(X.is_blank(text), F.lit(False))
        .when(F.coalesce(answer, F.lit("")) != "", A.says_yes(answer))
        .otherwise(long_enough))


def keep_articles(df: DataFrame, text: str, answer: str, error: str | None = None) -> DataFrame:
    """Drop rows that hold a text which is no article; a model error keeps the row."""
    value = F.col(f"`{text}`")
    keep = value.isNull() | is_article(value, F.col(answer))
    if error:
        keep = keep | F.coalesce(F.col(error), F.lit(False))
    return df.where(keep)


def fallback_score(words: Column) -> Column:
    """Score by length alone: 0 without words, one more from 1, 100 and 300 words on."""
    return A.length_score(F.coalesce(words, F.lit(0)), LENGTH_STEPS)


def relevance_scores(
    mentions: DataFrame, replies: DataFrame | None, key: str, text: str = "Title text",
) -> DataFrame:
    """Add ``Relevance``: the answer's digit, else by length; 0 for an error or a missing title.

    Every row stays. ``replies`` holds at most one row (key, answer, error) per mention, or is
    None when no model ran. It carries no text, so only the short reply travels to the mention.
    Words are counted only where the length decides.
    """
    if replies is None:
        replied = mentions.withColumns({
            "__answer": F.lit(None).cast("string"), "__error": F.lit(False)})
    else:
        replied = mentions.join(replies.select(
            key, F.col("answer").alias("__answer"), F.col("error").alias("__error")), key, "left")
    failed = F.col("Title").isNull() | F.coalesce("__error", F.lit(False))
    digit = F.when(failed, 0).otherwise(A.parse_score(F.col("__answer")))
    return (
        replied.withColumn("__digit", digit)
        .withColumn("__words", F.when(
            F.col("__digit").isNull(), X.word_count(F.col(f"`{text}`"))))
        .withColumn("Relevance", F.coalesce("__digit", fallback_score(F.col("__words"))))
        .drop("__answer", "__error", "__digit", "__words"))


Scorer = Callable[[Column, Column, Column], Column]
Judge = Callable[[Column], Column]


def score_with(mentions: DataFrame, scorer: Scorer, text: str = "Title text") -> DataFrame:
    """Score with a caller's scorer over (person, title, text); a null score becomes 0.

    A scorer is anything that maps three columns to one: a column expression or a pandas UDF.
    """
    score = scorer(F.col("Person"), F.col("Title"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return mentions.withColumn("Relevance", F.coalesce(score.cast("int"), F.lit(0)))


def filter_with(mentions: DataFrame, judge: Judge,
                text: str = "Title text") -> DataFrame:
    """Keep rows whose text a caller's judge accepts; null texts and null verdicts are kept."""
    value = F.col(f"`{text}`")
    return mentions.where(value.isNull() | F.coalesce(judge(value), F.lit(True)))


def arrow_scorer(score: Callable[[str, str, str], int]) -> Scorer:
    """A Python scoring function as a scorer: Arrow batches, one failed row scores null."""
    def guarded(person, title, text):
        try:
            return int(score(person, title, text))
        except Exception:
            return None

    @F.pandas_udf("int")
    def batch(person: pd.Series, title: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series(
            [guarded(*row) for row in zip(person, title, text)], dtype="Int32")

    return batch


def score_batches(
    mentions: DataFrame, score: Callable[[pd.DataFrame], pd.Series], text: str = "Title text",
) -> DataFrame:
    """Score whole Arrow batches, for models that answer many rows per call."""
    names = mentions.columns

    def run(frames):
        for frame in frames:
            values = pd.Series(score(frame[["Person", "Title", text]]), index=frame.index)
            yield frame.assign(Relevance=values.fillna(0).astype("int32"))[names + ["Relevance"]]

    schema = mentions.select("*", F.lit(0).alias("Relevance")).schema
    return mentions.mapInPandas(run, schema)
