"""Planning, ingest, resume state and publishing."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsroster.operators import ingest, planning, settings, state
from newsroster.plans.collect import collect, query_outcomes, query_pages
from newsroster.plans.process import Rules, process
from newsroster.plans.publish import publish
from newsroster.schema import BLACKLIST, COMPLETED, FAILURES, ITEM, LANDED, ROSTER
from newsroster.session import scratch_path
from newsroster.sinks import dashboard, files
from newsroster.sinks.state_store import StateStore
from newsroster.sources import rules as rule_lists
from newsroster.sources.files import read_csv, read_mentions, read_ragged_csv
from newsroster.sources.payloads import with_items
from newsroster.streaming.logs import ship_logs
from newsroster.streaming.resume import resume, resume_runs

TODAY = date(2024, 6, 30)


def roster(spark, *rows):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)],
                                 "ord long, " + ", ".join(f"`{c}` string" for c in ROSTER.names))


def test_expand_roster(spark):
    df = roster(spark, (" Definitely", " Eng ", "Ukr", 'A, "B", ,"C,', ), ("OPTIONAL ", "Opt", "", ""),
                (None, "Eng", None, "Eng"))
    plain = planning.expand_roster(df).orderBy("ord", "pos").collect()
    assert [r["query"] for r in plain] == ["Eng", "Ukr"]
    every = planning.expand_roster(df, True, True).orderBy("ord", "pos").collect()
    assert [r["query"] for r in every] == ["Eng", "Ukr", "A", "B", "C", "Opt"]


def test_mixed_case_keys(spark):
    log = spark.createDataFrame([(1, "A", "1"), (2, "a", "2"), (3, "A", "3"), (4, " ", "x"), (5, "b", "")],
                                "ord int, Key string, Value string")
    assert dict(map(tuple, settings.resolve_params(log).collect())) == {"a": "2", "b": ""}


def test_layers(spark):
    make = lambda *rows: spark.createDataFrame(rows, "key string, value string")
    out = settings.layer_settings([make(("X", ""), ("y", "1")), make(("x", "2"), ("Y", "3")), make(("z", "4"))])
    assert {r["key"]: (r["value"], r["layer"]) for r in out.collect()} == {
        "x": ("2", 1), "y": ("1", 0), "z": ("4", 2)}


def test_sort_parameter(spark):
    cases = [(True, None, None, "date"), (False, None, None, None), (True, "2024-1-5", None, "date:r:20240105:20240630"),
             (False, None, "20240201", "date:r:19700101:20240201"), (True, "junk", " ", "date")]
    df = spark.createDataFrame([(n, *c[:3]) for n, c in enumerate(cases)], "n int, d boolean, a string, b string")
    rows = df.select("n", planning.sort_parameter(F.col("d"), F.col("a"), F.col("b"), TODAY)).orderBy("n").collect()
    assert [r[1] for r in rows] == [c[3] for c in cases]


def test_date_range(spark):
    df = spark.createDataFrame([("2024-01-05T00:00",), ("2024-02-01",), (None,), ("soon",)], "d string")
    count = lambda a, b: planning.in_date_range(df, "d", a, b, TODAY).count()
    assert [count(None, None), count("2024-01-6", None), count(None, "20240131"), count("x", "")] == [4, 1, 1, 4]


def test_plan_pages(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 500), ("d", 10)], "query string, wanted int")
    rows = planning.plan_pages(df, F.col("wanted")).orderBy("query", "page").collect()
    assert [(r["start"], r["num"]) for r in rows if r["query"] == "a"] == [(1, 10), (11, 10), (21, 5)]
    assert len([r for r in rows if r["query"] == "c"]) == 10
    assert {r["query"] for r in rows} == {"a", "c", "d"}


def test_quota_classes(spark):
    cases = [("google", 429, "", "quota"), ("google", 403, "Quota exceeded for metric", "quota"),
             ("google", 403, "missing a valid key", "failure"), ("google", 500, "", "failure"),
             (" SearXNG", 403, "quota", "failure"), ("searxng", 429, "", "quota"),
             ("google", None, "timeout", "failure")]
    df = spark.createDataFrame([(n, *c[:3]) for n, c in enumerate(cases)],
                               "n int, provider string, status int, message string")
    rows = ingest.classify_attempts(df.withColumn("body", F.lit("")).withColumn("bad_body", F.lit(True)))
    assert [r["outcome"] for r in rows.orderBy("n").collect()] == [c[3] for c in cases]


def hit(link, day=None):
    out = {"title": f"About {link}", "link": link, "displayLink": "news.example.com"}
    if day:
        out["pagemap"] = {"metatags": [{"article:published_time": day}]}
    return out


def attempt(query, page, body, status=200, try_no=1, provider="google", message="", run=1):
    if not isinstance(body, str):
        body = json.dumps(body)
    return (query, 0, provider, run, page, try_no, status, message, body)


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), LANDED)


def outcomes(spark, *rows, cap=100):
    out = query_outcomes(query_pages(landed(spark, *rows), cap), cap).collect()
    return {r["query"]: (r["status"], [i["link"] for i in r["items"]]) for r in out}


def test_partial_results(spark):
    fail = lambda q, p: [attempt(q, p, "", 500, t) for t in (1, 2, 3)]
    found = outcomes(
        spark, *fail("first", 1), attempt("first", 2, {"items": [hit("x")]}),
        attempt("later", 1, {"items": [hit("a")]}), attempt("later", 2, {"items": [hit("b")]}), *fail("later", 3),
        attempt("later", 4, {"items": [hit("c")]}),
        attempt("retry", 1, "", 500, 1), attempt("retry", 1, {"items": [hit("r")]}, 200, 2),
        attempt("fourth", 1, {"items": [hit("r")]}, 200, 4),
        attempt("quota", 1, {"items": [hit("a")]}), attempt("quota", 2, "", 429),
        attempt("end", 1, {"items": [hit("a")]}), attempt("end", 2, {}), attempt("end", 3, {"items": [hit("z")]}),
        attempt("short", 1, {"items": []}), attempt("short", 2, {"items": [hit("s")]}),
        attempt("junk", 1, "<html>"), attempt("deep", 11, {"items": [hit("n")]}))
    assert found == {
        "first": ("failed", []), "later": ("done", ["a", "b"]), "retry": ("open", []),
        "fourth": ("open", []), "quota": ("quota", []), "end": ("done", ["a"]), "short": ("open", []),
        "junk": ("open", [])}
    # What was open is done as soon as the plan is read to its end.
    assert outcomes(spark, attempt("fourth", 1, {"items": [hit("r")]}, 200, 4), cap=10) == {
        "fourth": ("done", ["r"])}


def test_latest_run_decides_in_any_order(spark):
    quota, ok = attempt("q", 1, "", 429, run=1), attempt("q", 1, {"items": [hit("a")]}, run=2)
    for rows in ((quota, ok), (ok, quota)):
        assert outcomes(spark, *rows, cap=10) == {"q": ("done", ["a"])}
        assert outcomes(spark, *[r[:3] + (3 - r[3],) + r[4:] for r in rows], cap=10) == {"q": ("quota", [])}


def test_gaps_and_caps(spark):
    ten = {"items": [hit(str(n)) for n in range(10)]}
    found = outcomes(
        spark, attempt("gap", 1, ten), attempt("gap", 3, ten),
        *[attempt("long", p, ten) for p in range(1, 13)], attempt("long", 13, {}), cap=None)
    assert found["gap"] == ("open", []) and len(found["long"][1]) == 120
    page = {"results": [{"title": "t", "url": "http://a.x/1"}]}
    capped = outcomes(spark, attempt("q", 1, page, provider="searxng"),
                      attempt("q", 2, "", 429, provider="searxng"), cap=1)
    assert capped == {"q": ("done", ["http://a.x/1"])}
    assert len(outcomes(spark, *[attempt("q", p, ten) for p in range(1, 21)], cap=200)["q"][1]) == 200


def test_half_read_query_stays_pending(spark):
    people = roster(spark, ("", "q", "", ""))
    ten = {"items": [hit(str(n)) for n in range(10)]}
    first, rest = attempt("q", 1, ten), [attempt("q", p, ten, run=2) for p in range(2, 11)]
    one = collect(people, landed(spark, first), *tables(spark))
    assert one.completed.count() == one.failures.count() == 0 and not one.status.first()["complete"]
    two = collect(people, landed(spark, first, *rest), one.completed, one.failures)
    assert len(two.completed.first()["items"]) == 100 and two.status.first()["complete"]


def test_one_failed_try_of_three_is_no_failure(spark):
    people = roster(spark, ("", "q", "", ""))
    run = collect(people, landed(spark, attempt("q", 1, "", 500)), *tables(spark))
    assert run.failures.count() == run.completed.count() == 0
    none = collect(people, landed(spark), *tables(spark), max_results=0)
    assert none.completed.first()["items"] == [] and none.status.first()["complete"]


def test_meta_dialect(spark):
    page = lambda *urls: {"results": [{"title": "t", "url": u, "publishedDate": "2024-05-01"} for u in urls]}
    found = outcomes(
        spark, attempt("q", 1, page("http://a.x/1", "", "http://a.x/1"), provider=" SearXNG "),
        attempt("q", 2, page("http://a.x/1", "http://b.x/2"), provider="searxng"),
        attempt("q", 3, page(), provider="searxng"), attempt("q", 4, page("http://c.x/3"), provider="searxng"),
        attempt("dup", 1, {"items": [hit("a"), hit("a"), hit("b")]}), cap=2)
    assert found == {"q": ("done", ["http://a.x/1", "http://b.x/2"]), "dup": ("done", ["a", "a"])}
    row = with_items(landed(spark, attempt("q", 1, page("http://u@a.x:1/1"), provider="searxng"))).select(
        F.col("items")[0]["displayLink"], ingest.item_date(F.col("items")[0])).first()
    assert tuple(row) == ("u@a.x:1", "2024-05-01")


def test_unique_links(spark):
    data = [("q", 1, 0, "a"), ("q", 1, 1, "a"), ("q", 1, 2, ""), ("q", 2, 0, "b"), ("q", 2, 1, "c"),
            ("p", 1, 0, "a"), ("p", 1, 1, None)]
    df = spark.createDataFrame(data, "query string, page int, pos int, link string")
    rows = ingest.unique_links_capped(df, 2).collect()
    assert sorted((r["query"], r["link"]) for r in rows) == [("p", "a"), ("q", "a"), ("q", "b")]


def test_only_planned_pages_count(spark):
    pages = [attempt("q", p, {"items": [hit(f"{p}-{n}") for n in range(9)]}) for p in (1, 2, 3, 4)]
    people = roster(spark, ("", "q", "", ""))
    run = collect(people, landed(spark, *pages), *tables(spark), max_results=25)
    # Three pages are asked for; a short page is not made up for by a fourth.
    found = [i["link"] for i in run.completed.first()["items"]]
    assert found == [f"{p}-{n}" for p in (1, 2, 3) for n in range(9)][:25]


def tables(spark):
    return spark.createDataFrame([], COMPLETED), spark.createDataFrame([], FAILURES)


NAMES = ["Ada L", "Bo M", "Cy N", "Di O"]


def test_resume_after_quota(spark):
    people = roster(spark, *[("", n, "", "") for n in NAMES])
    good = [attempt(n, 1, {"items": [hit(f"http://x/{n}", "2024-05-01T10:00:00Z")]}) for n in NAMES]
    stopped = attempt(NAMES[2], 1, "", 429)
    one = collect(people, landed(spark, *good[:2], stopped), *tables(spark), max_results=10)
    assert tuple(one.status.first()) == (2, 2, False)
    store = StateStore(spark, scratch_path(spark, "resume"))
    store.save(one.completed, one.failures)
    # The second run sees all attempts; only the unfinished queries are taken from them.
    changed = attempt(NAMES[0], 1, {"items": [hit("http://changed")]})
    two = collect(people, landed(spark, changed, *good[2:]), *store.load(), max_results=10)
    assert tuple(two.status.first()) == (4, 0, True)
    rows = two.raw.orderBy("ord").collect()
    assert [r["Link"] for r in rows] == [f"http://x/{n}" for n in NAMES]
    assert rows[0]["Date"] == "2024-05-01T10:00:00Z"


def test_give_up_on_third_failure(spark):
    people = roster(spark, ("", "q", "", ""), ("", "other", "", ""))
    failed = landed(spark, *[attempt("q", 1, "", 500, t) for t in (1, 2, 3)])
    state_now = tables(spark)
    for expected in (1, 2):
        run = collect(people, failed, *state_now)
        assert [tuple(r) for r in run.failures.collect()] == [("q", expected)]
        state_now = run.completed, run.failures
    run = collect(people, failed, *state_now)
    assert run.failures.count() == 0
    assert [tuple(r)[1:] for r in run.raw.collect()] == [("q", "", "", "", "")]


def test_state_operators(spark):
    item = spark.createDataFrame([("Bo", [{"link": "x"}])], COMPLETED)
    failures = spark.createDataFrame([("Bo", 2), ("Cy", 1)], FAILURES)
    completed, left = state.mark_done(tables(spark)[0], failures, item)
    assert completed.first()["items"][0]["link"] == "x"
    assert [tuple(r) for r in left.collect()] == [("Cy", 1)]
    again = state.record_failures(state.record_failures(left, left.select("query")), left.select("query"))
    assert [tuple(r) for r in state.give_up(again).collect()] == [("Cy", 3, "give_up")]
    queries = spark.createDataFrame([("Bo",), ("Cy",)], "query string")
    assert [r["query"] for r in state.pending_queries(queries, completed).collect()] == ["Cy"]
    stored = {r["query"]: len(r["items"]) for r in state.stored_results(queries, completed).collect()}
    assert stored == {"Bo": 1, "Cy": 0}


def test_state_store(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    assert [t.count() for t in store.load()] == [0, 0]
    item = spark.createDataFrame([("Bo", [{"link": "x"}]), ("Empty", [])], COMPLETED)
    failures = spark.createDataFrame([("q", 2)], FAILURES)
    store.save(item, failures)
    fresh = StateStore(spark, str(tmp_path / "state"))
    assert {r["query"]: r["items"] for r in fresh.load()[0].collect()}["Empty"] == []
    # A version without its marker is not there yet.
    (tmp_path / "state" / "v=2" / "completed").mkdir(parents=True)
    assert fresh.version() == 1
    fresh.clear()
    assert [t.count() for t in fresh.load()] == [0, 0]
    # Two complete versions stay, however many runs there are.
    for _ in range(3):
        last = fresh.save(item, failures)
    assert fresh._versions() == [last, last - 1] and fresh.load()[0].count() == 2
    assert sorted(p.name for p in (tmp_path / "state").iterdir())[-2:] == [f"v={last - 1}", f"v={last}"]


def test_corrupt_state_starts_fresh(spark, tmp_path):
    root = tmp_path / "state" / "v=1"
    for name in ("completed", "failures"):
        (root / name).mkdir(parents=True)
        (root / name / "part.parquet").write_text("{not valid json")
    (root / "COMPLETE").write_text("")
    assert [t.count() for t in StateStore(spark, str(tmp_path / "state")).load()] == [0, 0]


def test_blacklist_sheet(spark):
    sheet = spark.createDataFrame(
        [(0, " bad.com ", "word", None, "A", "B"), (1, "", " ", "x", "A", " C "), (2, "bad.org", "", "", "D", "")],
        "ord int, " + ", ".join(f"`{c}` string" for c in BLACKLIST.names))
    rules = Rules.from_sheet(sheet)
    assert sorted(r[0] for r in rules.domains.collect()) == ["bad.com", "bad.org"]
    assert [tuple(r) for r in rules.renames.collect()] == [("A", "C")]
    assert [r[0] for r in rule_lists.values_of(rule_lists.blacklist_rules(sheet), "link").collect()] == ["x"]


def test_csv_round_trip(spark, tmp_path):
    row = ("P", ' a "quoted", line\nbreak ', "", None, "NA")
    df = spark.createDataFrame([row], "Person string, Title string, Date string, Source string, Link string")
    files.write_csv(df, str(tmp_path / "out"))
    assert tuple(read_csv(spark, str(tmp_path / "out")).first()) == ("P", row[1], None, None, None)


def test_ragged_csv(spark, tmp_path):
    for name, lines in (("a", 'x,"E, F"\ny,E,U,"s, t",extra\n'), ("b", "z\n")):
        (tmp_path / f"{name}.csv").write_text(",".join(ROSTER.names) + "\n" + lines)
    rows = read_ragged_csv(spark, str(tmp_path), ROSTER).orderBy("Priority").collect()
    assert [tuple(r) for r in rows] == [("x", "E, F", "", ""), ("y", "E", "U", "s, t"), ("z", "", "", "")]


def test_links_file_and_first_query(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, {"link": "a"}), (1, {"title": "no link"}), (2, {"link": "b"})],
        "query_ord int, item " + ITEM.simpleString())
    assert files.write_links(files.first_query_items(df), str(tmp_path / "links")) == 1
    assert [r[0] for r in spark.read.text(str(tmp_path / "links")).collect()] == ["a"]


def test_dashboard_upsert_is_idempotent(spark):
    board = spark.createDataFrame([(0, " raw_csv_link", "old"), (1, "k", "v"), (2, "raw_csv_link", "old")],
                                  "ord long, key string, value string")
    changes = spark.createDataFrame([(0, "raw_csv_link", "R"), (1, "sorted_csv_link", "S")],
                                    "ord long, key string, value string")
    once = dashboard.upsert(board, changes)
    expected = [(0, " raw_csv_link", "old"), (1, "k", "v"), (2, "raw_csv_link", "R"), (4, "sorted_csv_link", "S")]
    assert [tuple(r) for r in once.orderBy("ord").collect()] == expected
    assert [tuple(r) for r in dashboard.upsert(once, changes).orderBy("ord").collect()] == expected
    empty = dashboard.upsert(board.where("false"), changes)
    assert sorted(r["ord"] for r in empty.collect()) == [0, 1]


def test_publish(spark, tmp_path):
    people = roster(spark, *[("", n, "", "") for n in NAMES])
    good = [attempt(n, 1, {"items": [hit(f"http://x.org/{n}")]}) for n in NAMES]
    store = StateStore(spark, str(tmp_path / "state"))
    at = datetime(2024, 5, 1, 9, 30)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rank = lambda raw: process(raw, Rules(), pages)
    part = publish(collect(people, landed(spark, *good[:2]), *store.load(), max_results=10), rank, store, str(tmp_path), at)
    assert part["complete"] is False and part["ranked"] is None
    assert part["raw"].endswith("/2024-05-01_09-30_search_results.csv")
    assert [r[0] for r in spark.read.text(part["links"]).collect()] == [f"http://x.org/{NAMES[0]}"]
    full = publish(collect(people, landed(spark, *good), *store.load(), max_results=10), rank, store, str(tmp_path), at)
    assert full["complete"] and store.load()[0].count() == 0
    assert read_mentions(spark, full["raw"]).count() == 4
    results = spark.read.parquet(str(tmp_path / "results"))
    assert results.columns[:2] == ["Verified", "Relevance"] and results.count() == 4
    assert {r["key"] for r in full["board"].collect()} == {"raw_csv_link", "sorted_csv_link"}


def test_stream_takes_each_file_once(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("landed", "items", "check"))
    run = lambda: resume(spark, path, out, check, max_files=1)
    landed(spark, attempt("a", 1, {"items": [hit("x"), hit("y")]})).coalesce(1).write.mode("append").parquet(path)
    run()
    landed(spark, attempt("b", 1, {"items": [hit("z")]}), attempt("b", 2, "", 500)).coalesce(1).write.mode(
        "append").parquet(path)
    run()
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted(r["Link"] for r in rows) == ["x", "y", "z"]


def test_stream_into_the_state(spark, tmp_path):
    path, seen, check = (str(tmp_path / n) for n in ("landed", "attempts", "check"))
    store = StateStore(spark, str(tmp_path / "state"))
    people = roster(spark, ("", "a", "", ""), ("", "b", "", ""), ("", "c", "", ""))

    def run(*rows):
        if rows:
            landed(spark, *rows).coalesce(1).write.mode("append").parquet(path)
        resume_runs(spark, people, path, seen, store, check, max_results=20)
        completed, failures = store.load()
        return ({r["query"]: [i["link"] for i in r["items"]] for r in completed.collect()},
                {r["query"]: r["n"] for r in failures.collect()})

    bad = [attempt("b", 1, "", 500, t) for t in (1, 2, 3)]
    assert run(attempt("a", 1, {"items": [hit("x")]}), attempt("c", 1, "", 429), *bad) == ({}, {"b": 1})
    # The second page of a and a new run of c; b brings nothing new and counts no failure again.
    two = run(attempt("a", 2, {"items": [hit("y")]}, run=2),
              *[attempt("c", p, {"items": [hit(f"z{p}")]}, run=2) for p in (1, 2)])
    assert two == ({"a": ["x", "y"], "c": ["z1", "z2"]}, {"b": 1})
    assert run() == two


def test_log_stream(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("records", "log", "check"))
    rows = [(1, datetime(2024, 1, 1, 10), "INFO", "main", "a"), (2, datetime(2024, 1, 1, 11), "INFO", "google.auth", "b"),
            (3, datetime(2024, 1, 1, 12, 0, 1), "ERROR", "google_like_name", "c")]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp, level string, logger_name string, message string")
    df.write.parquet(path)
    ship_logs(spark, path, df.schema, out, check)
    kept = sorted((r["event_id"], r["time"]) for r in spark.read.parquet(out).collect())
    assert kept == [(1, "2024-01-01 10:00:00"), (3, "2024-01-01 12:00:01")]


def test_publish_repeated_after_a_crash(spark, tmp_path):
    """Killed between the result append and the state clear, the repeated job leaves each row once."""
    from newsroster.sinks.files import published_results

    people = roster(spark, *[("", n, "", "") for n in NAMES])
    good = [attempt(n, 1, {"items": [hit(f"http://x.org/{n}")]}) for n in NAMES]
    store = StateStore(spark, str(tmp_path / "state"))
    at = datetime(2024, 5, 2, 9, 30)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rank = lambda raw: process(raw, Rules(), pages)
    clear = store.clear

    def crash():
        raise RuntimeError("killed")

    store.clear = crash
    with pytest.raises(RuntimeError):
        publish(collect(people, landed(spark, *good), *store.load(), max_results=10), rank, store, str(tmp_path), at)
    store.clear = clear
    again = publish(collect(people, landed(spark, *good), *store.load(), max_results=10), rank, store, str(tmp_path),
                    at)
    assert again["complete"]
    results = published_results(spark, str(tmp_path / "results"))
    assert results.count() == 4 and {r["run"] for r in results.collect()} == {"202405020930"}
    # a later run is a run of its own
    later = datetime(2024, 5, 3, 9, 30)
    publish(collect(people, landed(spark, *good), *store.load(), max_results=10), rank, store, str(tmp_path), later)
    assert published_results(spark, str(tmp_path / "results")).count() == 8


def test_headers_read_only_file_heads(spark, tmp_path):
    from newsroster.sources.files import headers

    (tmp_path / "a.csv").write_bytes("﻿Link,Title\r\nhttp://x,\"two\nlines\"\n".encode())
    (tmp_path / "b.csv").write_text("Title,Link\n" + "t,l\n" * 20000)
    (tmp_path / "empty.csv").write_text("")
    found = headers(spark, str(tmp_path))
    assert {names: [f.rsplit("/", 1)[1] for f in files] for names, files in found.items()} == {
        ("Link", "Title"): ["a.csv"], ("Title", "Link"): ["b.csv"]}
    rows = read_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 20001 and {r["Title"] for r in rows} == {"t", "two\nlines"}


def test_days_outside_the_window_are_not_read(spark, tmp_path):
    from newsroster.sinks.by_day import read_days, write_by_day

    rows = spark.createDataFrame([("a", "2024-01-05T10:00"), ("b", "2024-01-20"), ("c", "2024-02-01"),
                                  ("d", None), ("e", "soon")], "Link string, Date string")
    path = str(tmp_path / "by_day")
    write_by_day(rows, path)
    # a broken file in a day outside the window: reading it would fail
    (tmp_path / "by_day" / "day=2024-02-01" / "part-broken.parquet").write_bytes(b"not parquet")
    window = read_days(spark, path, "2024-01-5", "20240120", TODAY)
    assert sorted(r["Link"] for r in window.collect()) == ["a", "b"]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_pages_not_wanted_are_dropped_before_parsing(spark):
    from newsroster.operators.enrich import page_facts, wanted_pages

    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://p/"), "id").alias("url"),
                                     F.lit("<article>x</article>").alias("html"))
    links = spark.range(0, 2000, 100).select(F.concat(F.lit("http://p/"), "id").alias("Link"))
    kept = wanted_pages(pages, links.union(spark.createDataFrame([(None,), ("",)], "Link string")))
    urls = {r["url"] for r in kept.collect()}
    assert {r["Link"] for r in links.collect()} <= urls and len(urls) <= 60  # 20 wanted of 2000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    whole = {r["url"]: tuple(r) for r in page_facts(pages).join(links, F.col("url") == F.col("Link"), "left_semi").collect()}
    assert {r["url"]: tuple(r) for r in page_facts(pages, wanted=links).join(
        links, F.col("url") == F.col("Link"), "left_semi").collect()} == whole


def test_damaged_state_is_empty_and_other_errors_are_raised(spark, tmp_path, monkeypatch):
    store = StateStore(spark, str(tmp_path / "state"))
    done = spark.createDataFrame([("a", [])], COMPLETED)
    store.save(done, spark.createDataFrame([("b", 1)], FAILURES))
    broken = tmp_path / "state" / f"v={store.version()}" / "failures"
    for part in broken.glob("*.parquet"):
        part.write_bytes(b"damaged")
    completed, failures = store.load()
    assert completed.count() == 1 and failures.count() == 0
    from pyspark.errors import PySparkException

    class Unreachable(PySparkException):
        def getCondition(self):
            return "CONNECTION_REFUSED"

    def refuse(*args, **kwargs):
        raise Unreachable("store down")

    monkeypatch.setattr(type(spark.read), "parquet", refuse)
    with pytest.raises(Unreachable):
        store.load()
