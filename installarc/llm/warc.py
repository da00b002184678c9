"""WARC archives: pages written as records, and records read back along verified boundaries. DataFrame functions only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from installarc.llm.common import stage_for
from installarc.sources.tables import Staging

# Fixed values of the format: how a record begins, what ends its header and the record, and the profile of a revisit.
MAGIC, BREAK = "WARC/1.", "\r\n\r\n"
# A break's last byte and the next magic. No header line begins so; and as its first byte occurs in it once, it is found
# wherever a split or a reader's buffer ends (readers that restart a failed match behind it miss others there).
CUT = "\n" + MAGIC
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100  # smaller payloads are never revisited


def sha256(payload: Column) -> Column:
    return F.sha2(payload.cast("binary"), 256)


# --- writing -----------------------------------------------------------------------------


def record_text(kind: Column, first_id: Column, date: str) -> Column:
    """A record of columns id, url, payload, bytes and digest, without the break behind it."""

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))

    def urn(page: Column, what: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(page.cast("string")), F.lit("")), F.lit(":"), F.col("digest"), what)

    revisit = kind == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(BREAK)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    return F.concat(
        F.lit(f"{MAGIC}1\r\nWARC-Type: "),
        kind,
        line("WARC-Record-ID", F.concat(urn(F.col("id"), F.when(revisit, ":revisit").otherwise("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Page-ID", F.url_encode(F.col("id").cast("string"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        line("WARC-Refers-To", F.when(revisit, F.concat(urn(first_id, F.lit("")), F.lit(">")))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )


def write(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    records_per_file: int = 50_000,
) -> None:
    """Write each page as one record of the archives in the folder ``path``: a response, or a revisit of an equal payload.

    Of pages with equal payloads of ``least_bytes`` or more the one of the smallest id (NULL last, then by url) is the
    response, all others refer to it. Only payloads that occur more than once are looked up, in a written table of
    digests, so pages are shuffled only where that table is large; a payload of very many copies is counted before it is shuffled.

    A NULL html is an empty payload; NULL ids and urls leave out their line. Of rows that repeat id, url and payload
    one is the response. An empty table writes no record. Line breaks in a url are escaped. Other columns are ignored.
    """
    stage = stage_for(pages)
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload")
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": sha256(F.col("payload"))})
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "url")
    shared = stage(
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes", "id", "url")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest", "bytes")
        .agg(F.min(rank).alias("first"), F.min_by("n", rank).alias("equal_first"), F.sum("n").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    marked = rows.join(shared.select("digest", "first", "equal_first"), "digest", "left")
    is_first = F.coalesce(F.col("first").eqNullSafe(rank) | F.col("first").isNull(), F.lit(True))
    kind = F.when(is_first, "response").otherwise("revisit")
    out = marked.filter(~is_first | F.col("equal_first").isNull() | (F.col("equal_first") == 1))
    out = out.select(record_text(kind, F.col("first.id"), date).alias("record"))
    twins = shared.filter("equal_first > 1")
    if not twins.isEmpty():
        one = marked.filter(is_first & (F.col("equal_first") > 1)).dropDuplicates(["digest"])
        more = twins.select(
            "digest", "bytes", "first.id", "first.url", F.lit("").alias("payload"), "first", F.explode(F.sequence(F.lit(2), F.col("equal_first")))
        )
        out = out.unionByName(one.select(record_text(F.lit("response"), F.col("first.id"), date).alias("record")))
        out = out.unionByName(more.select(record_text(F.lit("revisit"), F.col("first.id"), date).alias("record")))
    out.write.option("lineSep", BREAK).option("maxRecordsPerFile", records_per_file).text(path)


# --- reading -----------------------------------------------------------------------------


def parsed(rest: Column) -> dict[str, Column]:
    """What a record says that follows its magic in ``rest``; ``whole`` if ``rest`` holds just this record, with the break behind it or without."""
    head = F.substring_index(rest, BREAK, 1)
    head_bytes = F.octet_length(head)

    def field(name: str, empty: bool = False) -> Column:
        line = f"(?i)\\r\\n{name}:[ \\t]*([^\\r\\n]*)"
        found = F.regexp_extract(head, line, 1)
        return F.when(head.rlike(line) if empty else found != "", found)

    length = F.expr("if(length(_length) <= 12, try_cast(_length as bigint), null)")  # else sums could overflow
    size = F.octet_length(rest).cast("long")
    valid = rest.rlike("^[0-9]\\r\\n") & (size >= head_bytes + 4) & (F.col("length") >= 0)
    over = F.col("size") - F.col("head_bytes") - 4 - F.col("length")
    whole = F.col("valid") & (((over == 3) & rest.endswith(BREAK[:-1])) | ((over == 4) & rest.endswith(BREAK)))
    block = F.substring(rest.cast("binary"), F.col("head_bytes") + 5, F.col("length").try_cast("int")).cast("string")
    is_http = F.coalesce(F.lower("content_type").startswith("application/http"), F.lit(False))
    payload = F.when(~is_http, block).otherwise(F.substring(block.cast("binary"), F.octet_length(F.substring_index(block, BREAK, 1)) + 5, F.octet_length(block)).cast("string"))
    payload = F.when(F.col("whole"), payload)
    return {
        "_length": field("Content-Length"),
        "head_bytes": head_bytes,
        "size": size,
        "type": F.lower(field("WARC-Type")),
        "record_id": field("WARC-Record-ID"),
        "page_id": F.url_decode(field("WARC-Page-ID", empty=True)),
        "url": field("WARC-Target-URI"),
        "declared": field("WARC-Payload-Digest"),
        "refers": field("WARC-Refers-To"),
        "content_type": field("Content-Type"),
        "length": length,
        "valid": F.coalesce(valid, F.lit(False)),
        "whole": F.coalesce(whole, F.lit(False)),
        "payload": payload,
        "payload_bytes": F.octet_length("payload").cast("long"),
        "payload_digest": F.when(F.col("payload").isNotNull(), sha256(F.col("payload"))),
    }


FIELDS = ["type", "record_id", "page_id", "url", "declared", "refers", "length", "payload_bytes", "payload_digest"]


def _parse(rows: DataFrame) -> DataFrame:
    for name, value in parsed(F.col("rest")).items():
        rows = rows.withColumn(name, value)
    return rows


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut before each magic at the start of a line: (file, block, nth, piece), in splits that Spark chooses; ``nth`` orders those of a split."""
    return spark.read.text(path, lineSep=CUT).select(
        F.col("value").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
    )


def _after_magic(piece: Column) -> Column:
    """A file's first piece still has its magic."""
    return F.when(piece.startswith(MAGIC), F.substring(piece.cast("binary"), len(MAGIC) + 1, F.octet_length(piece)).cast("string")).otherwise(piece)


def _located(piece: Column) -> list[Column]:
    """A piece's length and 96 bits of hashes, by which its bytes are found again."""
    return [F.octet_length(piece).cast("long").alias("p_size"), F.xxhash64(piece).alias("p_a"), F.hash(piece).alias("p_b")]


def reachable(edges: DataFrame, roots: DataFrame, stage: Staging) -> DataFrame:
    """(file, run) of all runs on the chains from the roots, by pointer jumping.

    ``edges`` (file, run, to) leads forwards only. After k rounds pointers span 2^k edges and all runs within
    2^k - 1 edges of a root are marked, so the rounds grow with the logarithm of the longest chain.
    """
    jump, marked = edges, roots
    while not jump.isEmpty():
        ahead = marked.join(jump, ["file", "run"]).select("file", F.col("to").alias("run"))
        marked = stage(marked.unionByName(ahead).distinct())
        onward = jump.select("file", F.col("run").alias("to"), F.col("to").alias("further"))
        jump = stage(jump.join(onward, ["file", "to"]).select("file", "run", F.col("further").alias("to")))
    return marked


class Archive(NamedTuple):
    """``records``: (file, offset, what their headers say, payload_bytes, payload_digest). ``files``: (file, file_size, records, reached, intact)."""

    records: DataFrame
    files: DataFrame


def read(spark: SparkSession, path: str, payloads: bool = False) -> Archive:
    """The records of uncompressed archives under ``path``; with ``payloads`` their text (bytes as they are) as well.

    Boundary-chain verification: files are cut at each magic, whether it begins a record or lies in a payload, in splits of
    any size. Each piece is a candidate that says where its successor begins. Offsets follow from the pieces' lengths,
    added up inside a split and then over the splits of a file. Neighbouring candidates of which each leads to the next form a
    run; pointer jumping from the start of a file over the runs (as many as splits and stray magics) leaves those that
    the chain reaches. All others are bytes of a payload. A record with a magic in its payload is put together from its pieces.

    A chain that meets something else than a record ends there: ``files`` says how many bytes it reached, and whether
    that is all (``intact``). An empty file has no records and is intact. Only a record as a whole is one value in one task.
    """
    stage = Staging(spark)
    keep = [*FIELDS, "payload"] if payloads else FIELDS
    opened = F.col("piece").startswith(MAGIC)
    cut = _parse(_pieces(spark, path).withColumns({"rest": _after_magic(F.col("piece")), "opened": opened}))
    nodes = stage(cut.select("file", "file_size", "block", "nth", "opened", "head_bytes", "valid", "whole", *keep, *_located(F.col("piece"))))
    within = Window.partitionBy("file", "block").orderBy("nth")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    span = F.col("p_size") + len(CUT)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = nodes.groupBy("file", "block").agg(F.sum(span).alias("n"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    # only a file's first piece may bring its magic along, and it must
    starts_file = F.col("start") == 0
    candidate = F.col("valid") & (F.col("opened") == starts_file)
    offset = F.when(starts_file, F.col("start")).otherwise(F.col("start") - len(MAGIC))
    successor = F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length") + 8
    following = F.col("start") + span - len(MAGIC)
    begins = F.coalesce(~F.lag("linked").over(within), F.lit(True))
    placed = (
        nodes.join(blocks, ["file", "block"])
        .withColumn("start", F.col("base") + F.coalesce(F.sum(span).over(earlier), F.lit(0)))
        .withColumns({"offset": offset, "valid": candidate})
        .withColumn("successor", F.when(F.col("valid"), successor))
        .withColumn("linked", F.coalesce(F.col("successor") == following, F.lit(False)))
        .withColumn("run", F.last(F.when(begins, F.col("offset")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("base", "opened")
    )
    placed = stage(placed)
    runs = placed.groupBy("file", "run").agg(F.max_by("successor", "offset").alias("exit"))
    targets = placed.select("file", F.col("offset").alias("exit"), F.col("run").alias("to"))
    edges = stage(runs.filter("exit is not null").join(targets, ["file", "exit"]))
    roots = placed.filter("offset = 0").select("file", "run")
    marked = reachable(edges.select("file", "run", "to"), roots, stage)
    first = (
        edges.join(marked, ["file", "run"])
        .select("file", F.col("to").alias("run"), F.col("exit").alias("from"))
        .unionByName(roots.withColumn("from", F.lit(0).cast("long")))
        .groupBy("file", "run")
        .agg(F.min("from").alias("from"))
    )
    reached = F.coalesce(F.col("valid") & (F.col("offset") >= F.col("from")), F.lit(False))
    chain = stage(placed.join(stage(first), ["file", "run"], "left").withColumn("reached", reached).drop("from", "run", "linked", "nth"))

    in_block = Window.partitionBy("file", "block").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("reached"), F.col("offset"))
    found = chain.filter("reached and whole").select("file", "offset", *keep)
    if not chain.filter("reached and not whole").isEmpty():
        carried = chain.groupBy("file", "block").agg(F.max(own).alias("last"))
        carried = carried.select("file", "block", F.max("last").over(before).alias("carried"))
        parts = chain.join(carried, ["file", "block"]).withColumn("owner", F.coalesce(F.last(own, ignorenulls=True).over(in_block), "carried"))
        broken = chain.filter("reached and not whole").select("file", F.col("offset").alias("owner"), F.col("successor").alias("until"))
        parts = stage(
            parts.join(broken, ["file", "owner"]).filter("offset < until").select("file", "owner", "until", "offset", "p_size", "p_a", "p_b")
        )
        place = ["p_size", "p_a", "p_b"]
        bodies = _pieces(spark, path).select("piece", *_located(F.col("piece"))).join(parts.select(*place).distinct(), place, "left_semi")
        joined = (
            parts.join(bodies.dropDuplicates(place), place)
            .groupBy("file", F.col("owner").alias("offset"), "until")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("offset").alias("at"), "piece"))).alias("all"))
            .withColumn("rest", _after_magic(F.array_join(F.transform("all", lambda x: x["piece"]), CUT)).cast("binary"))
            .withColumn("rest", F.substring("rest", 1, F.col("until") - F.col("offset") - len(MAGIC)).cast("string"))
        )
        found = found.unionByName(_parse(joined).filter("whole").select("file", "offset", *keep))
    ends = chain.groupBy("file").agg(
        F.first("file_size").alias("file_size"), F.count_if("reached").alias("records"), F.coalesce(F.max(F.when(F.col("reached"), F.col("successor"))), F.lit(0)).alias("reached")
    )
    return Archive(found, ends.withColumn("intact", F.col("reached") == F.col("file_size")))


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes, payload_digest and ``refers_to`` of revisits taken from the response they refer to."""
    of = records.filter("type = 'response'").select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest")
    )
    taken = ["payload_bytes", "payload_digest"]
    found = records.filter("type = 'revisit'").drop(*taken).join(of.dropDuplicates(["refers"]), "refers", "left")
    found = found.withColumnsRenamed({"full_bytes": taken[0], "full_digest": taken[1]})
    rest = records.filter("type is null or type <> 'revisit'")  # they refer to nothing, so they don't meet in the join
    return rest.withColumn("refers_to", F.lit(None).cast("string")).unionByName(found)
