"""Explicit schemas of the landed and derived tables; nothing is inferred."""

from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("displayLink", T.StringType()),
    T.StructField("pagemap", T.StructType([
        T.StructField("metatags", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ])),
])

META_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedDate", T.StringType()),
])

# One landed HTTP attempt for one result page of one query; runs tell the days apart.
LANDED = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("query_ord", T.LongType()),
    T.StructField("provider", T.StringType()),
    T.StructField("run", T.IntegerType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("try_no", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("body", T.StringType()),
])

# Column names and order of the raw export.
RAW_COLUMNS = ["Person", "Title", "Date", "Source", "Link"]
RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

COMPLETED = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM)),
])
FAILURES = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("n", T.IntegerType()),
])

# The headers of the sheets.
ROSTER = T.StructType([
    T.StructField(c, T.StringType())
    for c in ("Priority", "Member ENG", "Member UKR", "Pronounciations")
])
PARAMETERS = T.StructType([T.StructField(c, T.StringType()) for c in ("Key", "Value")])
BLACKLIST = T.StructType([
    T.StructField(c, T.StringType())
    for c in ("Domains", "Stop Words", "Links to Remove", "Rewrite (Old)", "Rewrite (New)")
])
