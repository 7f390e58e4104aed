from newsroster.plans.collect import collect
from newsroster.schema import COMPLETED, FAILURES
from test_search import attempt, hit, landed, roster

PAGES = {("a", 1): 10, ("a", 2): 10, ("b", 1): 10, ("b", 2): 0, ("c", 1): 4, ("d", 1): 10, ("d", 2): 3}


def body(query, page):
    n = PAGES.get((query, page))
    return {"items": [hit(f"{query}{page}-{i}") for i in range(n)]} if n else {}


def fetch(plan, run):
    return [attempt(r["query"], r["page"], body(r["query"], r["page"]), run=run) for r in plan.collect()]


def state(run):
    return {r["query"]: [i["link"] for i in r["items"]] for r in run.completed.collect()}


def test_two_budgeted_days_equal_one_unlimited_run(spark):
    people = roster(spark, ("", "a", "", ""), ("", "b", "", ""), ("", "c", "", ""), ("", "d", "", ""))
    none = spark.createDataFrame([], COMPLETED), spark.createDataFrame([], FAILURES)
    nothing = spark.createDataFrame([], landed(spark, attempt("x", 1, {})).schema)

    day0 = collect(people, nothing, *none, max_results=20, budget=4)
    first = day0.plan.orderBy("ord", "pos", "page").collect()
    # a and b take two calls each; c does not fit after them
    assert [(r["query"], r["page"], r["start"], r["num"]) for r in first] == [
        ("a", 1, 1, 10), ("a", 2, 11, 10), ("b", 1, 1, 10), ("b", 2, 11, 10)]
    seen = fetch(day0.plan, 1)
    day1 = collect(people, landed(spark, *seen), *none, max_results=20, budget=4)
    assert sorted(state(day1)) == ["a", "b"]
    assert sorted((r["query"], r["page"]) for r in day1.plan.collect()) == [("c", 1), ("c", 2), ("d", 1), ("d", 2)]
    seen += fetch(day1.plan, 2)
    day2 = collect(people, landed(spark, *seen), day1.completed, day1.failures, max_results=20, budget=4)
    assert day2.plan.count() == 0

    every = [attempt(q, p, body(q, p), run=1) for q in "abcd" for p in (1, 2)]
    unlimited = collect(people, landed(spark, *every), *none, max_results=20)
    assert state(day2) == state(unlimited)
    assert state(day2)["c"] == [f"c1-{i}" for i in range(4)]


def test_plan_goes_on_at_the_first_unread_page(spark):
    people = roster(spark, ("", "a", "", ""), ("", "b", "", ""))
    none = spark.createDataFrame([], COMPLETED), spark.createDataFrame([], FAILURES)
    rows = [attempt("a", 1, body("a", 1)), *[attempt("b", 1, "", 500, t) for t in (1, 2, 3)]]
    run = collect(people, landed(spark, *rows), *none, max_results=20, budget=10)
    assert sorted((r["query"], r["page"]) for r in run.plan.collect()) == [("a", 2), ("b", 1), ("b", 2)]
    assert collect(people, landed(spark, *rows), *none, max_results=20, budget=1).plan.count() == 1
