"""Search planning and settings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.dates import compact_date
from ..functions.text import to_int, truthy
from ..operators import planning as P
from ..operators.ordering import order_by, with_position
from ..operators.settings import layer_settings, resolve_params
from .landed import Landed, oracle

TODAY = date(2024, 6, 30)


def roster_sheet(landed):
    return landed.roster.select(
        "ord", F.col("priority").alias("Priority"), F.col("member_eng").alias("Member ENG"),
        F.col("member_ukr").alias("Member UKR"), F.col("spellings").alias("Pronounciations"))


def expand_roster(spark, folder):
    return P.expand_roster(roster_sheet(Landed(spark, folder)))


def expand_roster_all(spark, folder):
    return P.expand_roster(roster_sheet(Landed(spark, folder)), optional=True, spellings=True)


def resolved(spark, folder):
    return resolve_params(Landed(spark, folder).setting_log, ["tenant"])


def effective_params(spark, folder):
    """Three layers per tenant; the value is also read as a number and as a switch."""
    landed = Landed(spark, folder)
    sheet = resolve_params(landed.setting_log, ["tenant"])
    orders = landed.orders.select(
        F.col("o_custkey").alias("tenant"), F.lower("o_orderstatus").alias("key"), "o_orderkey")
    override = orders.groupBy("tenant", "key").agg(
        F.max("o_orderkey").cast("string").alias("value"))
    defaults = landed.customer.select(
        F.col("c_custkey").alias("tenant"),
        F.explode(F.array(F.lit("click"), F.lit("o"), F.lit("LOG_BATCH_SIZE"))).alias("key")
    ).withColumn("value", F.when(F.col("key") == "LOG_BATCH_SIZE", " 25 ")
                 .when(F.col("key") == "o", "Yes").otherwise("none"))
    layers = layer_settings([override, sheet, defaults], ["tenant"])
    return layers.select(
        "tenant", "key", "value", "layer", to_int(F.col("value")).alias("number"),
        truthy(F.col("value")).alias("switch"))


def decode_query(spark, folder):
    words = Landed(spark, folder).customer.select(
        "c_custkey", F.concat(F.url_encode("c_name"), F.lit("+a%20b%D0%9E")).alias("query"))
    return P.decode_queries(words)


def normalize_date(spark, folder):
    return Landed(spark, folder).date_texts.select(
        "o_orderkey", compact_date(F.col("s")).alias("day"))


def date_window(spark, folder):
    landed = Landed(spark, folder)
    ends = landed.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("e"),
                                F.col("o_orderstatus").alias("status"))
    rows = landed.date_texts.join(ends, "o_orderkey")
    end = F.when(F.col("status") == "F", F.col("e"))
    return rows.select("o_orderkey", P.sort_parameter(
        F.col("status") != "O", F.col("s"), end, TODAY).alias("sort"))


def date_range_filter(spark, folder):
    rows = Landed(spark, folder).mentions
    return P.in_date_range(rows, "Date", "2024-01-5", "20240120", TODAY)


def date_range_stored(spark, folder):
    """The same window over mentions stored by day: only the folders of the window's days are read."""
    from ..session import scratch_path
    from ..sinks.by_day import read_days, write_by_day

    path = scratch_path(spark, "by_day")
    write_by_day(Landed(spark, folder).mentions, path, "Date")
    return read_days(spark, path, "2024-01-5", "20240120", TODAY)


def newest_first(spark, folder):
    rows = Landed(spark, folder).mentions.select("ord", "Link", "Date")
    return with_position(rows, order_by(["Date"], False))


def plan_pages(spark, folder):
    queries = Landed(spark, folder).customer.select(
        F.col("c_name").alias("query"), F.floor("c_acctbal").cast("int").alias("wanted"))
    return P.plan_pages(queries, F.pmod(F.col("wanted"), F.lit(130))).drop("wanted")


def quota_cut(spark, folder):
    """Queries a budget of calls covers, in roster order."""
    pending = Landed(spark, folder).orders.select(
        F.col("o_orderkey").alias("query"),
        P.page_cost(F.floor(F.col("o_totalprice") / 1000)).alias("calls"))
    return P.within_budget(pending, ["query"], "calls", 5000)


QUERIES = {
    "expand_roster": expand_roster, "expand_roster_all": expand_roster_all,
    "resolve_params": resolved, "effective_params": effective_params,
    "decode_query": decode_query, "normalize_date": normalize_date, "date_window": date_window,
    "date_range_filter": date_range_filter, "date_range_stored": date_range_stored, "newest_first": newest_first,
    "plan_pages": plan_pages, "quota_cut": quota_cut,
}

_NAMES = """
    SELECT ord, 0 AS pos, trim(member_eng) AS query FROM {roster} WHERE %(who)s
    UNION ALL SELECT ord, 1, trim(member_ukr) FROM {roster} WHERE %(who)s"""
_SPELLINGS = """
    UNION ALL SELECT ord, pos + 2, regexp_replace(trim(part), '^[,"]+|[,"]+$', '', 'g')
    FROM (SELECT ord, unnest(string_split(trim(spellings), ',')) AS part,
                 generate_subscripts(string_split(trim(spellings), ','), 1) - 1 AS pos
          FROM {roster} WHERE %(who)s)"""
_EXPANDED = """
    SELECT query, min(ord) AS ord, CAST(arg_min(pos, ord * 1000 + pos) AS INT) AS pos
    FROM {names} WHERE query <> '' GROUP BY query"""
_RESOLVED = """
    SELECT tenant, lower(Key) AS key, arg_max(v, first_ord) AS value
    FROM (SELECT tenant, Key, min(ord) AS first_ord, arg_max(Value, ord) AS v
          FROM {setting_log} WHERE trim(Key) <> '' GROUP BY tenant, Key)
    GROUP BY tenant, lower(Key)"""
_COMPACT = """
    SELECT o_orderkey, s,
           CASE WHEN contains(s, '-') THEN strftime(TRY_CAST(
                    regexp_replace(regexp_replace(trim(s), '-([0-9])-', '-0\\1-'), '-([0-9])$', '-0\\1')
                    AS DATE), '%Y%m%d')
                WHEN regexp_full_match(trim(s), '[0-9]{8}')
                THEN strftime(try_strptime(trim(s), '%Y%m%d'), '%Y%m%d') END AS day
    FROM {date_texts}"""
# The doubled braces of a repetition count would read as a reference.
_COMPACT = _COMPACT.replace("[0-9]{8}", "[0-9]" * 8)

ORACLE = {
    "expand_roster": oracle(_EXPANDED, names=_NAMES % {
        "who": "lower(trim(priority)) <> 'optional'"}),
    "expand_roster_all": oracle(_EXPANDED, names=(_NAMES + _SPELLINGS) % {"who": "true"}),
    "resolve_params": oracle(_RESOLVED),
    "effective_params": oracle("""
        SELECT tenant, key, value, layer, TRY_CAST(trim(value) AS INT) AS number,
               lower(trim(value)) IN ('1', 'true', 'yes') AS switch
        FROM (SELECT tenant, key, arg_min(value, layer) AS value, min(layer) AS layer
              FROM {stacked} WHERE value <> '' GROUP BY tenant, key)""",
        resolved=_RESOLVED, stacked="""
        SELECT o_custkey AS tenant, lower(o_orderstatus) AS key,
               CAST(max(o_orderkey) AS VARCHAR) AS value, 0 AS layer
        FROM {orders} GROUP BY 1, 2
        UNION ALL SELECT tenant, key, value, 1 FROM {resolved}
        UNION ALL SELECT c_custkey, k, v, 2
        FROM {customer}, (VALUES ('click', 'none'), ('o', 'Yes'), ('log_batch_size', ' 25 ')) AS d(k, v)"""),
    "decode_query": oracle("""
        SELECT c_custkey, replace(c_name, '#', '%23') || '+a%20b%D0%9E' AS query,
               c_name || '+a b' || chr(1054) AS decoded FROM customer"""),
    "normalize_date": oracle("SELECT o_orderkey, day FROM {compacted}", compacted=_COMPACT),
    "date_window": oracle("""
        SELECT d.o_orderkey,
               CASE WHEN d.day IS NOT NULL OR o_orderstatus = 'F'
                    THEN 'date:r:' || coalesce(d.day, '19700101') || ':' ||
                         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
                              ELSE '20240630' END
                    WHEN o_orderstatus <> 'O' THEN 'date' END AS sort
        FROM {compacted} d JOIN orders o ON o.o_orderkey = d.o_orderkey""", compacted=_COMPACT),
    "date_range_filter": oracle("""
        SELECT * FROM {mentions}
        WHERE CAST(substring(Date, 1, 10) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "date_range_stored": oracle("""
        SELECT * FROM {mentions}
        WHERE CAST(substring(Date, 1, 10) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "newest_first": oracle("""
        SELECT ord, Link, Date, row_number() OVER (ORDER BY Date DESC NULLS LAST, ord) AS rank
        FROM {mentions}"""),
    "plan_pages": oracle("""
        SELECT query, CAST(start AS INT) AS start, CAST((start - 1) // 10 + 1 AS INT) AS page,
               CAST(least(10, wanted - start + 1) AS INT) AS num
        FROM (SELECT c_name AS query, wanted, unnest(range(1, wanted + 1, 10)) AS start
              FROM (SELECT c_name, least(((CAST(floor(c_acctbal) AS INT) % 130) + 130) % 130, 100) AS wanted
                    FROM customer))"""),
    "quota_cut": oracle("""
        SELECT query, calls, calls_so_far
        FROM (SELECT query, calls, CAST(sum(calls) OVER (ORDER BY query) AS BIGINT) AS calls_so_far
              FROM (SELECT o_orderkey AS query, CAST(ceil(greatest(least(
                           floor(o_totalprice / 1000), 100), 0) / 10) AS INT) AS calls FROM orders))
        WHERE calls_so_far <= 5000"""),
}
