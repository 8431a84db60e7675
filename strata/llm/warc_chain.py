"""WARC archives: writing, and reading by boundary-chain verification.

Writing: Spark's text writer with the record separator CR LF CR LF as line
separator; a row is one record (header, and the payload behind an HTTP
header block), so archives are committed as any other output. Records with
equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes are one
response, that of the smallest page id, and revisits of it.

Reading: a payload may itself hold the magic ``WARC/1.1``, and a task that
starts in the middle of a file can't tell such a place from a record. So
tasks read the pieces between magics of their own byte ranges, and emit for
every piece that parses as a header a candidate: its offset and that of its
successor (header + Content-Length + separator). A piece's offset is the
length of what lies before it, summed per byte range and over the ranges of
its file. Candidates that follow each other without a gap form runs; runs are
linked by their last successor, and pointer jumping from the start of each
file (log2 of a file's runs rounds, each a written table) finds the reachable
runs. Only records that a reachable run holds from its entry on are records;
all other magics are payload. Payloads that hold magics are put together
again from their pieces and verified like the others: digest and length are
those of the bytes read.

All steps are DataFrame functions. Defined cases: a null html is an empty
payload, a null url an empty target; CR and LF in a url are percent-encoded;
a null page id is written as an empty id and read as null, and is response
only in a group without any id; rows that repeat page id and payload are
records of their own (all responses if theirs is the smallest id); an empty
table gives archives without records and an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, drop, hint_if_small, stage
from strata.session import new_path

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hex digits are 4 base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), *_BASE32)


def records_of(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to): refers_to is null
    for a response."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"),
                        sha1_base32(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    firsts, _ = stage(rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                      .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "warc-firsts")
    return (rows.join(hint_if_small(firsts, firsts.count()), ["digest", "bytes"], "left")
            .withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")))
            .drop("first"))


def write_archives(records: DataFrame, path: str, *, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row, as plain WARC files under ``path``."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, *c: F.concat(F.lit(f"{name}: "), *c, F.lit("\r\n"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    common = [line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Target-URI", uri), line("WARC-Date", F.lit(date)),
              line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")), line("WARC-Payload-Length", F.col("bytes").cast("string"))]
    response = F.concat(F.lit(MAGIC), line("WARC-Type", F.lit("response")), *common,
                        line("Content-Type", F.lit("application/http; msgtype=response")),
                        line("Content-Length", (F.col("bytes") + len(HTTP)).cast("string")), F.lit("\r\n" + HTTP), F.col("payload"))
    revisit = F.concat(F.lit(MAGIC), line("WARC-Type", F.lit("revisit")), *common, line("WARC-Profile", F.lit(PROFILE)),
                       line("WARC-Refers-To", urn(F.col("refers_to"))), line("Content-Length", F.lit("0")), F.lit("\r\n"))
    (records.select(F.when(F.col("refers_to").isNull(), response).otherwise(revisit).alias("value"))
     .write.option("lineSep", GAP).text(path))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics, with its place among the pieces of its byte
    range, its header, and what a candidate needs."""
    text = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value"))
    has_head = F.instr("value", GAP) > 0
    head = F.when(has_head, F.substring_index("value", GAP, 1))
    rows = text.withColumns({"head": head, "bytes": F.octet_length("value").cast("long")})
    rows = rows.withColumn("length", F.regexp_extract(F.concat(F.lit("\r\n"), "head"), r"(?i)\r\nContent-Length: *(\d{1,18})", 1).try_cast("long"))
    rows = rows.withColumn("skip", (F.octet_length("head") + len(GAP)).cast("long"))
    whole = F.col("bytes") >= F.col("skip") + F.col("length")
    block = F.when(whole, F.substring(F.col("value").cast("binary"), (F.col("skip") + 1).cast("int"), F.col("length").cast("int")))
    return rows.withColumn("own", _payload(block)).withColumns(
        {"own_digest": sha1_base32(F.col("own")), "own_bytes": F.octet_length("own").cast("long")}).drop("own")


def _payload(block: Column) -> Column:
    """A response block's bytes behind its HTTP header."""
    head = F.octet_length(F.substring_index(block.cast("string"), GAP, 1))
    return F.when(head < F.octet_length(block), F.substring(block, head + len(GAP) + 1, 2147483647)).otherwise(F.lit(b""))


def _offsets(pieces: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``body``, the offset behind a piece's magic: what its byte
    range holds before it, and the ranges of its file before that."""
    in_block = Window.partitionBy("file", "block").orderBy("at")
    size = F.col("bytes") + len(MAGIC)
    blocks = pieces.groupBy("file", "block").agg(F.sum(size).alias("n"))
    before = blocks.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    placed = pieces.withColumn("inside", F.sum(size).over(in_block) - size)
    return placed.join(before, ["file", "block"]).select(*keep, (F.col("before") + F.col("inside")).alias("body"))


def _candidates(pieces: DataFrame) -> DataFrame:
    """(file, block, at, start, succ, run): offsets of magics; runs of
    candidates without a gap inside one byte range."""
    rows = (_offsets(pieces, ["file", "block", "at", "skip", "length"])
            .select("file", "block", "at", (F.col("body") - len(MAGIC)).alias("start"),
                    (F.col("body") + F.col("skip") + F.col("length") + len(GAP)).alias("succ"))
            .filter("start >= 0"))                    # the first piece of a file is before its magic
    ordered = Window.partitionBy("file", "block").orderBy("start")
    gap = F.coalesce((F.lag("succ").over(ordered) != F.col("start")).cast("int"), F.lit(1))
    return rows.withColumn("gap", gap).withColumn("run", F.sum("gap").over(ordered)).drop("gap")


def reachable(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, block, run, entry): runs that the chain from the start of their
    file enters, and where. Pointer jumping: every round doubles the steps a
    pointer takes and marks what the marked runs point to."""
    spark = candidates.sparkSession
    key = ["file", "block", "run"]
    runs = candidates.groupBy(*key).agg(F.max_by("succ", "start").alias("exit"), F.min("start").alias("first"))
    to = candidates.select("file", F.col("block").alias("to_block"), F.col("run").alias("to_run"), F.col("start").alias("exit"))
    jump, jump_path = stage(runs.join(to, ["file", "exit"]).select(*key, "to_block", "to_run", F.col("exit").alias("entry")), "warc-jump")
    marked, marked_path = stage(candidates.filter("start = 0").select(*key, F.col("start").alias("entry")), "warc-marked")
    while jump.limit(1).count():
        reached = marked.select(*key).join(jump, key).select("file", F.col("to_block").alias("block"), F.col("to_run").alias("run"), "entry")
        after, after_path = stage(marked.unionByName(reached).groupBy(*key).agg(F.min("entry").alias("entry")), "warc-marked")
        hop = jump.select("file", F.col("block").alias("to_block"), F.col("run").alias("to_run"),
                          F.col("to_block").alias("block2"), F.col("to_run").alias("run2"), F.col("entry").alias("entry2"))
        further, further_path = stage(
            jump.join(hop, ["file", "to_block", "to_run"])
            .select(*key, F.col("block2").alias("to_block"), F.col("run2").alias("to_run"), F.col("entry2").alias("entry")), "warc-jump")
        drop(spark, jump_path, marked_path)
        jump, jump_path, marked, marked_path = further, further_path, after, after_path
    drop(spark, jump_path)
    scratch.paths.append(marked_path)
    return marked


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, start, record_type, page_id, url,
    payload_bytes, payload_digest, refers_to. Digest and length of a response
    are those of its payload as read; a revisit's are those it names."""
    scratch = Scratch()
    pieces = scratch.stage(_pieces(spark, path).drop("value"), "warc-pieces")
    candidates = scratch.stage(_candidates(pieces), "warc-candidates")
    marked = reachable(candidates, scratch)
    is_record = F.coalesce(F.col("start") >= F.col("entry"), F.lit(False))
    chained = candidates.join(marked, ["file", "block", "run"], "left").withColumn("record", is_record)
    # every piece belongs to the last record that starts at or before it (small columns only)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = scratch.stage(
        chained.withColumn("owner", F.last(F.when(F.col("record"), F.col("start")), ignorenulls=True).over(upto))
        .filter("owner IS NOT NULL").select("file", "block", "at", "start", "owner"), "warc-owned")
    place = ["file", "block", "at"]
    info = pieces.select(*place, "head", "length", "own_digest", "own_bytes")
    parted = scratch.stage(owned.filter("start != owner").select("file", "owner").distinct(), "warc-parted")
    heads = owned.filter("start = owner").join(info, place)
    records = heads.join(parted, ["file", "owner"], "left_anti").select("file", "start", "head", "own_digest", "own_bytes")
    if parted.limit(1).count():
        records = records.unionByName(_from_parts(spark, path, owned.join(parted, ["file", "owner"]).select("file", "start", "owner"), scratch))
    field = lambda name, pattern: F.regexp_extract(F.concat(F.lit("\r\n"), "head", F.lit("\r\n")), rf"(?i)\r\n{name}: *{pattern}\r\n", 1)
    kind = field("WARC-Type", r"(\w+)")
    revisit = kind == "revisit"
    records, _ = stage(records.select(
        "file", "start", kind.alias("record_type"), field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").try_cast("long").alias("page_id"),
        field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        F.when(revisit, field("WARC-Payload-Length", "([0-9]+)").try_cast("long")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(revisit, field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)")).otherwise(F.col("own_digest")).alias("payload_digest"),
        F.when(revisit, field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").try_cast("long")).alias("refers_to")), "warc-records")
    scratch.drop(spark)
    return records


def _from_parts(spark: SparkSession, path: str, parts: DataFrame, scratch: Scratch) -> DataFrame:
    """Records whose payload holds magics, put together from ``parts`` (file,
    start, owner): only the files that have some are read again."""
    parts = scratch.stage(parts, "warc-parts")
    files = scratch.stage(parts.select("file").distinct(), "warc-files")
    again = _pieces(spark, path).drop("own_digest", "own_bytes").join(hint_if_small(files, files.count()), "file", "left_semi")
    rows = _offsets(again, ["file", "value", "head", "skip", "length"]).withColumn("start", F.col("body") - len(MAGIC))
    whole = (rows.join(hint_if_small(parts, parts.count()), ["file", "start"]).groupBy("file", "owner")
             .agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"), F.min_by("head", "start").alias("head"),
                  F.min_by("skip", "start").alias("skip"), F.min_by("length", "start").alias("length")))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).cast("binary")
    payload = _payload(F.substring(joined, (F.col("skip") + 1).cast("int"), F.col("length").cast("int")))
    return whole.select("file", F.col("owner").alias("start"), "head", payload.alias("payload")).select(
        "file", "start", "head", sha1_base32(F.col("payload")).alias("own_digest"), F.octet_length("payload").cast("long").alias("own_bytes"))


def archive_and_read(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(records_of(pages, min_bytes=min_bytes), path)
    return read_archives(spark, path)
