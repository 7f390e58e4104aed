"""The composite jobs and the streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import as_ranked, order_by, with_position
from ..plans.collect import collect
from ..plans.process import Rules, process
from ..plans.publish import publish
from ..schema import LANDED
from ..session import cut_lineage, scratch_path
from ..sinks.delta_state import DeltaState
from ..sinks.state_store import StateStore
from ..sources.files import read_mentions
from ..streaming.logs import ship_logs
from ..streaming.resume import resume, resume_delta, resume_runs
from .clean import BLOCKED, DEDUPED, PATTERNED, WORDED
from .enrich import sql_article, sql_text, sql_visible
from .ingest import LIMITS, STEPS
from .landed import Landed, oracle
from .planning import roster_sheet
from .relevance import sql_length_score, sql_score
from .state import stored

AT = datetime(2024, 6, 30, 12, 5)


def _collected(landed, completed=None):
    return collect(roster_sheet(landed), landed.landed(), completed or stored(landed),
                   landed.failure_counts, **LIMITS)


def collect_job(spark, folder):
    rows = _collected(Landed(spark, folder)).raw
    return rows.select(
        F.col("ord.ord").alias("row_ord"), F.col("ord.name").alias("name_ord"),
        F.col("ord.pos").alias("item_ord"), "Person", "Title", "Date", "Source", "Link")


def collect_plan(spark, folder):
    """The next run's pages under a budget of 50 calls: what the day's job asks for next."""
    landed = Landed(spark, folder)
    run = collect(roster_sheet(landed), landed.landed(), stored(landed), landed.failure_counts,
                  budget=50, **LIMITS)
    return run.plan


def _parts(completed, failures):
    return completed.select(
        "query", F.lit("completed").alias("part"), F.size("items").cast("long").alias("n")
    ).unionByName(failures.select(
        "query", F.lit("failures").alias("part"), F.col("n").cast("long").alias("n")))


def collect_state(spark, folder):
    """What the run leaves behind: item counts of completed queries, failure counts of others."""
    run = _collected(Landed(spark, folder))
    return _parts(run.completed, run.failures)


def stream_state(spark, folder):
    """Two runs of the stream into the state leave what one run over all attempts does."""
    landed = Landed(spark, folder)
    rows = landed.landed().select(*LANDED.names)
    root = scratch_path(spark, "stream_state")
    store = StateStore(spark, f"{root}/state")
    store.save(stored(landed), landed.failure_counts)
    for provider in ("google", " SearXNG "):
        rows.where(F.col("provider") == provider).write.mode("append").parquet(f"{root}/landed")
        resume_runs(spark, roster_sheet(landed), f"{root}/landed", f"{root}/attempts", store,
                    f"{root}/checkpoint", **LIMITS)
    return _parts(*store.load())


def stream_delta_state(spark, folder):
    """The same two runs into delta state: each batch writes what it changed, failures count once per run."""
    landed = Landed(spark, folder)
    rows = cut_lineage(landed.landed().select(*LANDED.names))  # the view is built once, not per provider
    root = scratch_path(spark, "stream_delta")
    state = DeltaState(spark, f"{root}/state", buckets=16)
    state.seed(stored(landed), landed.failure_counts)
    for provider in ("google", " SearXNG "):
        rows.where(F.col("provider") == provider).write.mode("append").parquet(f"{root}/landed")
        resume_delta(spark, roster_sheet(landed), f"{root}/landed", state, f"{root}/checkpoint", **LIMITS)
    completed = state.table("completed")
    open_failures = state.failures(state.table("ledger")).join(completed, "query", "left_anti")
    return _parts(completed, open_failures)


def _rules(landed):
    return Rules(*[landed.listed(f"few_{kind}") for kind in ("domains", "words", "patterns")],
                 landed.rename_rules)


def process_job(spark, folder):
    landed = Landed(spark, folder)
    ranked = process(landed.mentions, _rules(landed), landed.pages, landed.link_answers)
    return as_ranked(ranked.withColumnRenamed("Title text", "title_text"))


def process_job_tables(spark, folder):
    """The same job with rules as tables of any length, which are joined."""
    landed = Landed(spark, folder)
    rules = Rules(landed.domain_rules, landed.word_rules, landed.few_patterns, landed.rename_rules)
    ranked = process(landed.mentions, rules, landed.pages, landed.link_answers)
    return as_ranked(ranked.withColumnRenamed("Title text", "title_text"))


def publish_job(spark, folder):
    """A run in which everything is done: the ranked export as read back, in its order, the
    dashboard links, and a cleared state."""
    landed = Landed(spark, folder)
    everyone = landed.customer.select(F.col("c_name").alias("query")).join(
        stored(landed), "query", "left")
    names = landed.customer.select(
        F.col("c_custkey").alias("ord"), F.lit("").alias("Priority"),
        F.col("c_name").alias("Member ENG"), F.lit("").alias("Member UKR"),
        F.lit("").alias("Pronounciations"))
    none = spark.createDataFrame([], LANDED)
    run = collect(names, none, everyone, landed.failure_counts)
    root = scratch_path(spark, "publish")
    store = StateStore(spark, f"{root}/state")
    out = publish(run, lambda mentions: process(mentions, Rules(), landed.pages), store, root, AT,
                  landed.board)
    names = ["Relevance", "Person", "Title", "Date", "Source", "Link"]
    exported = read_mentions(spark, out["ranked"], T.StructType(
        [T.StructField(c, T.StringType()) for c in names]))
    links = out["board"].where("trim(key) IN ('raw_csv_link', 'sorted_csv_link')")
    return with_position(exported, order_by(["ord"], tie=None)).drop("ord").withColumns({
        "Relevance": F.col("Relevance").cast("int"), "complete": F.lit(out["complete"]),
        "state_rows": F.lit(store.load()[0].count()),
        "board_links": F.lit(links.where(F.col("value").endswith("csv")).count())})


def stream_resume(spark, folder):
    """Two runs of the stream; search attempts land first, the others before the second run."""
    landed = Landed(spark, folder).landed().select(*LANDED.names)
    root = scratch_path(spark, "stream")
    for provider in ("google", " SearXNG "):
        landed.where(F.col("provider") == provider).write.mode("append").parquet(f"{root}/landed")
        resume(spark, f"{root}/landed", f"{root}/items", f"{root}/checkpoint", max_files=16)
    return spark.read.parquet(f"{root}/items").drop("batch")


def stream_logs(spark, folder):
    records = Landed(spark, folder).log_records
    root = scratch_path(spark, "log_stream")
    for level in ("ERROR", "INFO"):
        records.where(F.col("level") == level).write.mode("append").parquet(f"{root}/records")
        ship_logs(spark, f"{root}/records", records.schema, f"{root}/log", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/log").select("event_id", "level", "time", "message")


def stream_log_batches(spark, folder):
    """The log stream with batch numbers of 25 rows, going on from one micro-batch to the next."""
    records = Landed(spark, folder).log_records
    root = scratch_path(spark, "log_batches_stream")
    for level in ("ERROR", "INFO"):
        records.where(F.col("level") == level).write.mode("append").parquet(f"{root}/records")
        ship_logs(spark, f"{root}/records", records.schema, f"{root}/log", f"{root}/checkpoint", batch_size=25)
    return spark.read.parquet(f"{root}/log").select(
        "event_id", "level", "time", "message", F.col("log_batch").alias("batch"), "position")


QUERIES = {
    "collect_job": collect_job, "collect_state": collect_state, "process_job": process_job,
    "process_job_tables": process_job_tables, "publish_job": publish_job,
    "stream_resume": stream_resume, "stream_state": stream_state, "stream_logs": stream_logs,
    "stream_delta_state": stream_delta_state, "collect_plan": collect_plan,
    "stream_log_batches": stream_log_batches,
}

# What one collect run must leave, on top of the steps of the ingest section.
_RUN = {
    "asked": """
        SELECT query, min(ord) AS ord, CAST(arg_min(pos, ord * 10 + pos) AS INT) AS pos FROM (
            SELECT trim(member_eng) AS query, ord, 0 AS pos FROM {roster}
            WHERE trim(priority) <> 'Optional'
            UNION ALL SELECT trim(member_ukr), ord, 1 FROM {roster}
            WHERE trim(priority) <> 'Optional') WHERE query <> '' GROUP BY query""",
    "waiting": "SELECT query FROM {asked} WHERE query NOT IN (SELECT query FROM {stored})",
    **STEPS,
    "tried": "SELECT * FROM {status_of} WHERE query IN (SELECT query FROM {waiting})",
    "found": """
        SELECT query, item_ord, title, published, host, link FROM (
            SELECT *, row_number() OVER (PARTITION BY query ORDER BY page, pos) - 1 AS item_ord
            FROM (SELECT p.query, p.page, i.pos, p.meta, i.title, i.published, i.link,
                         CASE WHEN p.meta THEN regexp_extract(i.link, '//([^/?#]*)', 1)
                              ELSE i.host END AS host,
                         row_number() OVER (PARTITION BY p.query, i.link
                                            ORDER BY p.page, i.pos) AS copy
                  FROM {partial} p JOIN {attempt_items} i ON i.event_id = p.event_id
                  WHERE p.usable AND p.query IN (SELECT query FROM {waiting}))
            WHERE NOT meta OR (link <> '' AND copy = 1)) WHERE item_ord < 20""",
    "counts": """
        SELECT query, sum(n) AS n FROM (
            SELECT query, n FROM {failure_counts}
            UNION ALL SELECT query, 1 FROM {tried} WHERE status = 'failed') GROUP BY query""",
    "finished": """
        SELECT query FROM {tried} WHERE status = 'done'
        UNION SELECT t.query FROM {tried} t JOIN {counts} c ON c.query = t.query
        WHERE t.status = 'failed' AND c.n >= 3""",
    "exported": """
        SELECT query, CAST(0 AS BIGINT) AS item_ord, title, '' AS published, '' AS host, link FROM {stored}
        UNION ALL SELECT f.query, coalesce(i.item_ord, 0), coalesce(i.title, ''),
                         coalesce(i.published, ''), coalesce(i.host, ''), coalesce(i.link, '')
        FROM {finished} f LEFT JOIN {found} i ON i.query = f.query""",
}


def _processed(domains: str, words: str, allowed: str) -> str:
    return oracle(f"""
        SELECT CASE WHEN k.Title IS NULL OR coalesce(a.error, false) THEN 0
                    ELSE coalesce({sql_score('a.answer')}, {sql_length_score('f.title_text')})
               END AS Relevance,
               coalesce(r.new, k.Person) AS Person, k.Title, left(k.Date, 10) AS Date, k.Source,
               k.Link, k.ord, f.title_text,
               row_number() OVER (ORDER BY CASE
                   WHEN k.Title IS NULL OR coalesce(a.error, false) THEN 0
                   ELSE coalesce({sql_score('a.answer')}, {sql_length_score('f.title_text')}) END DESC,
                   left(k.Date, 10) DESC NULLS LAST, k.ord) AS rank
        FROM {{kept}} k LEFT JOIN {{rename_rules}} r ON r.old = k.Person
        LEFT JOIN {{texts_of}} f ON f.url = k.Link
        LEFT JOIN {{link_answers}} a ON a.Link = k.Link""",
        deduped=DEDUPED,
        kept=f"""
        SELECT m.* FROM {{deduped}} m WHERE m.Link IS NOT NULL AND NOT {BLOCKED % domains}
        AND NOT {WORDED % words} AND {allowed}""",
        texts_of=f"""
        SELECT url, coalesce({sql_article('html')},
                             {sql_text(sql_visible('html'))}) AS title_text FROM pages""")


_OK = "SELECT * FROM {classified} WHERE outcome = 'ok' AND body_kind = 'list'"

_STATE = oracle("""
        SELECT query, 'completed' AS part, count(*) FILTER (WHERE link <> '' OR title <> '') AS n
        FROM {exported} GROUP BY query
        UNION ALL SELECT query, 'failures', CAST(n AS BIGINT) FROM {counts}
        WHERE query NOT IN (SELECT query FROM {finished})""", **_RUN)

ORACLE = {
    "collect_job": oracle("""
        SELECT coalesce(a.ord, 9223372036854775807) AS row_ord, coalesce(a.pos, 0) AS name_ord,
               CAST(e.item_ord AS INT) AS item_ord, e.query AS Person, e.title AS Title,
               e.published AS Date, e.host AS Source, e.link AS Link
        FROM {exported} e LEFT JOIN {asked} a ON a.query = e.query""", **_RUN),
    "collect_state": _STATE,
    "stream_state": _STATE,
    "stream_delta_state": _STATE,
    "collect_plan": oracle("""
        SELECT query, ord, pos, CAST(page AS INT) AS page, CAST((page - 1) * 10 + 1 AS INT) AS start,
               CAST(10 AS INT) AS num
        FROM {budgeted}, unnest(range(next, 3)) AS t(page) WHERE so_far <= 50""", **_RUN, pend="""
        SELECT query, ord, pos FROM {asked}
        WHERE query NOT IN (SELECT query FROM {stored}) AND query NOT IN (SELECT query FROM {finished})""",
        nxt="""
        SELECT query, count(*) FILTER (WHERE stop IS NULL) + 1 AS next FROM {asked_pages}
        WHERE query IN (SELECT query FROM {waiting}) GROUP BY query""", budgeted="""
        SELECT *, sum(calls) OVER (ORDER BY ord, pos ROWS UNBOUNDED PRECEDING) AS so_far FROM (
            SELECT p.*, coalesce(n.next, 1) AS next, 3 - coalesce(n.next, 1) AS calls
            FROM {pend} p LEFT JOIN {nxt} n USING (query)) WHERE calls > 0"""),
    "process_job": _processed("few_domains", "few_words", f"NOT {PATTERNED}"),
    "process_job_tables": _processed("domain_rules", "word_rules", f"NOT {PATTERNED}"),
    "publish_job": oracle("""
        SELECT row_number() OVER (ORDER BY query_ord) AS rank, CAST(0 AS INT) AS Relevance,
               query AS Person, title AS Title, CAST(NULL AS VARCHAR) AS Date,
               CAST(NULL AS VARCHAR) AS Source, link AS Link, true AS complete,
               CAST(0 AS INT) AS state_rows,
               CAST(2 AS INT) AS board_links
        FROM {stored}"""),
    "stream_resume": oracle("""
        SELECT a.query_ord, a.page, a.try_no, i.pos, a.query AS Person, i.title AS Title,
               coalesce(i.published, '') AS Date,
               CASE WHEN a.meta THEN regexp_extract(i.link, '//([^/?#]*)', 1) ELSE i.host END AS Source,
               i.link AS Link
        FROM {ok_attempts} a JOIN {attempt_items} i ON i.event_id = a.event_id""",
        classified=STEPS["classified"], ok_attempts=_OK),
    "stream_log_batches": oracle("""
        SELECT event_id, level, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, message,
               (CASE WHEN level = 'INFO' THEN (SELECT (count(*) + 24) // 25 FROM {shipped} WHERE level = 'ERROR')
                     ELSE 0 END) + (n - 1) // 25 AS batch,
               row_number() OVER (PARTITION BY level, (n - 1) // 25 ORDER BY n DESC) AS position
        FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY ts, event_id) AS n FROM {shipped})""",
        shipped="""
        SELECT * FROM {log_records} WHERE level IN ('ERROR', 'INFO')
        AND NOT (starts_with(logger_name, 'google.') OR starts_with(logger_name, 'urllib3')
                 OR starts_with(logger_name, 'gspread'))"""),
    "stream_logs": oracle("""
        SELECT event_id, level, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, message
        FROM {log_records}
        WHERE NOT (starts_with(logger_name, 'google.') OR starts_with(logger_name, 'urllib3')
                   OR starts_with(logger_name, 'gspread'))"""),
}
