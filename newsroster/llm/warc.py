"""WARC archives: write pages as records, read archives back by verified record chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored, text_of

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def with_revisits(pages: DataFrame, id: str, html: str, least_bytes: int) -> DataFrame:
    """``page_id, payload, n_bytes, digest, first_id`` and the other columns; ``first_id`` is
    null for a response.

    Only digests that occur more than once are matched with the pages, so mostly a small table
    travels and the payloads stay where they are read.
    """
    rows = pages.withColumns({
        "__payload": text_of(html), "__bytes": F.octet_length(text_of(html)).cast("long"),
        "__digest": F.sha2(text_of(html), 256)})
    firsts = stored(
        rows.where(F.col("__bytes") >= least_bytes).groupBy("__digest")
        .agg(F.min(f"`{id}`").alias("__first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"), "warc-firsts")
    key = F.when(F.col("__bytes") >= least_bytes, F.col("__digest"))
    return rows.withColumn("__key", key).join(
        firsts.withColumnRenamed("__digest", "__key"), "__key", "left").withColumn(
        "__first", F.when(~F.col(f"`{id}`").eqNullSafe(F.col("__first")), F.col("__first")))


def write_warc(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 100, date: str = "2000-01-01T00:00:00Z", per_file: int = 10_000,
) -> None:
    """Write one record per row below ``path``, in many uncompressed archives.

    The payload is the html in UTF-8 (null: empty) in an HTTP response. Of equal payloads of at
    least ``least_bytes`` bytes the row with the smallest id is a ``response``, the others are
    ``revisit`` records that refer to it and repeat its digest; shorter payloads are always
    responses. A null id is never the smallest unless all are null; rows that repeat the smallest
    id are all responses. Null urls leave out the target, line breaks in urls are escaped. An
    empty table writes an empty folder of archives; other columns are ignored.
    """
    rows = with_revisits(
        pages.select(F.col(f"`{id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.col(f"`{html}`").alias("html")), "page_id", "html", least_bytes)
    revisit = F.col("__first").isNotNull()
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("__bytes").cast("string"), F.lit(GAP))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("__payload")))
    head = F.concat_ws(
        "\r\n",
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("__digest")),
        F.when(revisit, f"WARC-Profile: {REVISIT}"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("__first")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    # The writer ends every row with the blank lines that end a record.
    rows.select(F.concat(F.lit(MAGIC), head, F.lit(GAP), block).alias("value")).write.option(
        "lineSep", GAP).option("maxRecordsPerFile", per_file).text(path)


def _header(head: Column, name: str) -> Column:
    value = F.regexp_extract(head, r"(?im)^" + name + r":[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def record_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, in file order: ``path, file, block, id, value``.

    The text scan cuts large archives into splits, so one file is read by many tasks. ``file`` is
    a hash of the path: the small tables that tell true records from others stay small.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value")


def candidate_edges(chunks: DataFrame) -> DataFrame:
    """``file, block, id, at, next``: where each magic stands and where its record would end.

    Places follow from chunk lengths: sums within a split, plus the sums of the splits before
    it. ``next`` is null where no header with a length follows the magic; the first chunk of a
    file stands before any magic and has a negative place.
    """
    head = F.substring_index("value", GAP, 1)
    length = F.octet_length("value")
    small = stored(chunks.select(
        "file", "block", "id", (length + len(MAGIC)).cast("long").alias("step"),
        F.when(F.octet_length(head) < length, F.octet_length(head) + len(MAGIC) + 2 * len(GAP)
               + _header(head, "Content-Length").try_cast("long")).alias("span")), "warc-chunks")
    in_block = Window.partitionBy("file", "block").orderBy("id")
    blocks = small.groupBy("file", "block").agg(F.sum("step").alias("total"))
    earlier = Window.partitionBy("file").orderBy("block")
    bases = blocks.select("file", "block", (F.sum("total").over(earlier) - F.col("total")).alias("base"))
    return (
        small.withColumn("before", F.sum("step").over(in_block) - F.col("step"))
        .join(bases, ["file", "block"])
        .withColumn("at", F.col("base") + F.col("before") - len(MAGIC))
        .select("file", "block", "id", "at", (F.col("at") + F.col("span")).alias("next")))


def reachable(edges: DataFrame) -> DataFrame:
    """Places ``file, at`` that the chain of records from the start of each file visits.

    Pointer jumping: a round follows all pointers found so far from all places reached so far,
    then doubles the pointers, so a file of n records needs about log2(n) rounds. Pointers that
    leave the candidates fall out. Each round is written to the shared folder.
    """
    candidates = edges.where("at >= 0")
    jump = candidates.where("next is not null").select("file", "at", "next").join(
        candidates.select("file", F.col("at").alias("next")), ["file", "next"], "left_semi")
    jump = stored(jump.select("file", "at", "next"), "warc-jump")
    reached = candidates.where("at = 0").select("file", "at")
    while not jump.isEmpty():
        further = reached.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = stored(reached.unionByName(further), "warc-reached")
        onward = jump.select("file", F.col("at").alias("next"), F.col("next").alias("to"))
        jump = stored(jump.join(onward, ["file", "next"]).select(
            "file", "at", F.col("to").alias("next")), "warc-jump")
    return reached


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``.

    Returns ``file, type, record_id, target_uri, refers_to, digest, block_bytes, payload``.
    A magic counts as a record only if the chain of record lengths from the start of its file
    leads to it; all others are payload and go back to the record they stand in. Bytes after a
    chain that breaks are left out. An empty folder gives no records.

    Most records are a single chunk and are taken where they are read. Only chunks of records
    that contain further magics are brought together, and only small columns are used to find
    out which those are.
    """
    chunks = record_chunks(spark, path)
    edges = candidate_edges(chunks)
    true_ = reachable(edges).withColumn("is_true", F.lit(True))
    marked = edges.join(true_, ["file", "at"], "left").withColumn(
        "start", F.when(F.col("is_true"), F.col("at"))).withColumn(
        "stop", F.when(F.col("is_true"), F.col("next")))
    own = F.struct("start", "stop")
    in_block = Window.partitionBy("file", "block").orderBy("at")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("file", "block").agg(
        F.max(F.when(F.col("is_true"), own)).alias("last")).select(
        "file", "block", F.max("last").over(earlier).alias("carried"))
    homes = marked.join(carried, ["file", "block"]).withColumn("home", F.coalesce(
        F.last(F.when(F.col("is_true"), own), True).over(in_block), F.col("carried")))
    inside = F.col("home.stop") > F.col("at")
    odd = stored(
        homes.where(F.col("is_true").isNull()).select(
            "file", "id", "at", F.when(inside, F.col("home.start")).alias("start")), "warc-odd")
    heads = odd.where("start is not null").select("file", F.col("start").alias("at")).distinct()
    # Records that hold further magics: their own first chunk takes part as well.
    parts = stored(
        odd.unionByName(homes.join(heads, ["file", "at"], "left_semi").select(
            "file", "id", "at", F.col("at").alias("start"))), "warc-parts")
    placed = chunks.select("path", "file", "id", "value").join(
        parts.withColumn("is_part", F.lit(True)), ["file", "id"], "left")
    whole = placed.where("is_part is null").select("path", "value")
    joined = placed.where("start is not null").groupBy("path", "start").agg(
        F.sort_array(F.collect_list(F.struct("at", "value"))).alias("p")).select(
        "path", F.array_join(F.transform("p", lambda x: x["value"]), MAGIC).alias("value"))
    head = F.substring_index("value", GAP, 1)
    block = F.substring(F.col("value"), F.length(head) + len(GAP) + 1,
                        F.length("value") - F.length(head) - 2 * len(GAP))
    parsed = whole.unionByName(joined).select("path", head.alias("head"), block.alias("block"))
    return parsed.where(_header(F.col("head"), "WARC-Type").isNotNull()).select(
        F.col("path").alias("file"), _header(F.col("head"), "WARC-Type").alias("type"),
        _header(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _header(F.col("head"), "WARC-Target-URI").alias("target_uri"),
        _header(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _header(F.col("head"), "WARC-Payload-Digest").alias("digest"),
        F.octet_length("block").cast("long").alias("block_bytes"),
        F.substring(F.col("block"), F.instr(F.col("block"), F.lit(GAP)) + len(GAP),
                    F.length("block")).alias("payload"))


def digest(records: DataFrame) -> DataFrame:
    """Per record: page, bytes and digest of its full payload, type, and the page it refers to.

    A revisit's payload is that of the response it refers to.
    """
    def page(name):
        return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    small = stored(records.select(
        "record_id", "refers_to", "type", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("type") == "response", F.sha2("payload", 256)).otherwise(
            F.regexp_replace("digest", "^sha256:", "")).alias("payload_digest")), "warc-read")
    responses = small.where("type = 'response'")
    # a revisit takes the bytes of the response it names with its own digest: ids may repeat
    referred = responses.groupBy(F.col("record_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("full_bytes"))
    revisits = small.where("type = 'revisit'").join(referred, ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.col("full_bytes")).drop("full_bytes")
    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
