from pyspark.sql import functions as F

from newsroster.plans.collect import collect
from newsroster.schema import COMPLETED
from newsroster.sinks.delta_state import LEDGER, DeltaState
from newsroster.streaming.resume import resume_delta
from test_search import attempt, hit, landed, roster


def _state(state):
    done = {r["query"]: [i["link"] for i in r["items"]] for r in state.table("completed").collect()}
    counts = {r["query"]: r["n"] for r in state.failures(state.table("ledger")).collect() if r["query"] not in done}
    return done, counts


def test_one_failure_counts_once_over_later_batches(spark, tmp_path):
    """Page 1 fails all tries in run 1; pages 2 and 3 land in two later runs: one failure, still pending."""
    path, check = str(tmp_path / "landed"), str(tmp_path / "check")
    state = DeltaState(spark, str(tmp_path / "state"), buckets=4)
    people = roster(spark, ("", "a", "", ""), ("", "b", "", ""))

    def run(*rows):
        landed(spark, *rows).coalesce(1).write.mode("append").parquet(path)
        resume_delta(spark, people, path, state, check, max_results=30)
        return _state(state)

    bad = [attempt("b", 1, "", 500, t, run=1) for t in (1, 2, 3)]
    assert run(attempt("a", 1, {"items": [hit("x")]}, run=1), *bad) == ({}, {"b": 1})
    assert run(attempt("b", 2, {"items": [hit("y")]}, run=2)) == ({}, {"b": 1})
    assert run(attempt("b", 3, {"items": [hit("z")]}, run=3)) == ({}, {"b": 1})
    # only batches with news for a query write rows for it: the two later batches add no ledger entries
    assert state.table("ledger").count() == 1
    # a real failure in a later run counts; page 1 of a new run that succeeds finishes the query
    assert run(*[attempt("b", 1, "", 500, t, run=4) for t in (1, 2, 3)]) == ({}, {"b": 2})
    fresh = [attempt("b", p, {"items": [hit(f"w{p}")]}, run=5) for p in (1, 2, 3)]
    assert run(*fresh) == ({"b": ["w1", "w2", "w3"]}, {})


def test_deltas_follow_the_batch_and_replay_is_equal(spark, tmp_path):
    state = DeltaState(spark, str(tmp_path / "state"), buckets=8)
    row = lambda q, links: (q, [{"title": None, "link": link, "displayLink": None, "pagemap": None} for link in links])
    done = spark.createDataFrame([row("a", ["x"]), row("b", ["y", "z"])], COMPLETED)
    state.write(0, completed=done, ledger=spark.createDataFrame([("c", 1)], LEDGER))
    before = _state(state)
    # a crash after the tables and before the commit leaves the state as it was
    more = spark.createDataFrame([row("c", ["v"])], COMPLETED)
    (more.withColumn("bucket", F.lit(0)).write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{state.path}/completed/batch=1"))
    assert _state(state) == before
    # the replay overwrites the batch's own folders, then commits: the same state as one clean write
    state.write(1, completed=more, ledger=spark.createDataFrame([], LEDGER))
    after = _state(state)
    assert after == ({"a": ["x"], "b": ["y", "z"], "c": ["v"]}, {})
    assert spark.read.parquet(f"{state.path}/completed/batch=1").count() == 1
    # only the buckets a batch touches are read
    touched = state.table("completed", [int(r[0]) for r in spark.read.parquet(
        f"{state.path}/completed/batch=1").select("bucket").distinct().collect()])
    assert "c" in {r["query"] for r in touched.collect()}
    # compaction gives the same state and later deltas still count
    state.compact()
    assert _state(state) == after
    state.write(2, completed=spark.createDataFrame([row("d", [])], COMPLETED))
    assert set(_state(state)[0]) == {"a", "b", "c", "d"}


def test_a_run_with_a_ledger_reads_its_bodies_once(spark):
    """The ledger, the counts and the finished queries come from one pass over the attempts."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(body):
        read.add(1)
        return body

    rows = landed(spark, *[attempt(q, 1, {"items": [hit(q)]}, run=1) for q in "abc"],
                  *[attempt("d", 1, "", 500, t, run=1) for t in (1, 2, 3)])
    people = roster(spark, *[("", q, "", "") for q in "abcd"])
    run = collect(people, rows.withColumn("body", noted.asNondeterministic()("body")),
                  spark.createDataFrame([], COMPLETED), None, ledger=spark.createDataFrame([("d", 0)], LEDGER),
                  max_results=10)
    assert {r["query"] for r in run.done.collect()} == {"a", "b", "c"}
    assert sorted(map(tuple, run.ledger.collect())) == [("d", 0), ("d", 1)]
    assert {r["query"]: r["n"] for r in run.failures.collect()} == {"d": 2}
    assert read.value == 6
