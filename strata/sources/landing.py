"""Landed (bronze) inputs derived from the given parquet tables.

The given ``events`` table is an app event stream without a session id,
purchases or user dimension. The mapping, kept in one place:

* session id   = user id and UTC calendar day of the event;
* purchases    = events of type ``purchase``, amount = ``value``;
* users        = ``customer`` joined to ``nation``: device_type is the
  market segment, country the nation name, signup_date the customer's
  first order date;
* raw text     = JSON lines / CSV lines rendered from those rows, so the
  raw readers, the corrupt split and the dedup run on data that grows with
  the tables.

Faults are injected by fixed rules on the event id (no randomness), so the
same rows are faulty on every run and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import session_key

# Fault-injection rules on event_id.
DUPLICATE_EVERY = 50      # retried delivery: same id, 1 s later, value + 1
NULL_SESSION_EVERY = 89   # session id missing
CORRUPT_EVERY = 97        # JSON line truncated (last character dropped)
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CURRENCY = "USD"          # the given events carry no currency


_READERS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given (read-only) table. The reader is reused within a session, so
    the file listing and footer schema are resolved once per table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _READERS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READERS[key] = spark.read.parquet(path)
    return df


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events: event_id, session_id, user_id, event_type,
    event_timestamp (timestamp, UTC), value, event_details struct."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        session_key(F.col("user_id"), ts).alias("session_id"),
        "user_id",
        "event_type",
        ts.alias("event_timestamp"),
        "value",
        F.from_json("props", "k bigint").alias("event_details"),
    )


def app_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases: transaction_id, session_id, user_id, amount, currency,
    transaction_timestamp."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        session_key(F.col("user_id"), ts).alias("session_id"),
        "user_id",
        F.col("value").alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        ts.alias("transaction_timestamp"),
    )


def app_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw users: user_id, signup_date (timestamp), device_type, country.

    nation (25 rows) is broadcast after its size check.
    The first order date per customer is a partial (map-side) aggregate.
    """
    from strata.operators.joins import broadcast_if_small
    c = table(spark, sf_dir, "customer")
    n = broadcast_if_small(table(spark, sf_dir, "nation"))
    first_order = (table(spark, sf_dir, "orders")
                   .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order")))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(first_order, c.c_custkey == first_order.o_custkey, "left")
            .select(F.col("c_custkey").alias("user_id"),
                    F.col("first_order").cast("timestamp").alias("signup_date"),
                    F.col("c_mktsegment").alias("device_type"),
                    F.col("n_name").alias("country")))


def event_json_lines(spark: SparkSession, sf_dir: str, faults: bool = True,
                     numeric_ids: bool = False) -> DataFrame:
    """One JSON text line per delivered event (column ``value``).

    With ``faults``: every DUPLICATE_EVERY-th event is delivered twice (the
    retry 1 s later with value + 1), every NULL_SESSION_EVERY-th has no
    session id, every CORRUPT_EVERY-th line is truncated.
    """
    e = table(spark, sf_dir, "events")
    base = e.select("event_id", "user_id", "event_type", "ts", "value", "props")
    if faults:
        retry = (base.filter(F.col("event_id") % DUPLICATE_EVERY == 0)
                 .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
                 .withColumn("value", F.col("value") + F.lit(1.0)))
        base = base.unionByName(retry)
    ts = F.col("ts").cast("timestamp")
    sid = session_key(F.col("user_id"), ts)
    if faults:
        sid = F.when(F.col("event_id") % NULL_SESSION_EVERY != 0, sid)
    id_type = "bigint" if numeric_ids else "string"
    line = F.to_json(F.struct(
        F.col("event_id").cast(id_type).alias("event_id"),
        sid.alias("session_id"),
        F.col("user_id").cast(id_type).alias("user_id"),
        "event_type",
        F.date_format(F.col("ts"), TS_TEXT).alias("event_timestamp"),
        F.struct(F.col("value").alias("price")).alias("event_details"),
    ))
    if faults:
        line = F.when(F.col("event_id") % CORRUPT_EVERY == 0,
                      F.substring(line, 1, F.length(line) - 1)).otherwise(line)
    return base.select(line.alias("value"))


ARRIVAL_ROWS = 500_000     # at most so many lines (about 128 MB) in one landed file


def land_event_files(spark: SparkSession, sf_dir: str, dest: str, files: int = 6,
                     faults: bool = True) -> str:
    """Write the event JSON lines as arrivals, each a contiguous range of
    event ids: one range-partitioned pass over all events, at least ``files``
    files and as many more as their size asks for."""
    lines = event_json_lines(spark, sf_dir, faults=faults, numeric_ids=True)
    n = table(spark, sf_dir, "events").count()           # parquet footers
    arrival = F.coalesce(F.get_json_object("value", "$.event_id").cast("bigint"), F.lit(0))
    (lines.repartitionByRange(max(files, -(-n // ARRIVAL_ROWS)), arrival)
     .write.mode("append").text(dest))
    _order_files(spark, dest)
    return dest


def _order_files(spark: SparkSession, dest: str) -> None:
    """A file stream takes files by modification time: give the files below a
    folder times that follow their names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(dest)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = fs.listFiles(folder, True), []
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            found.append((path.getParent().getName().rjust(64), path.getName(), path))
    start = fs.getFileStatus(folder).getModificationTime() - 1000 * len(found)
    for i, (_, _, path) in enumerate(sorted(found, key=lambda f: f[:2])):
        fs.setTimes(path, start + 1000 * i, -1)


def landed_files(spark: SparkSession, dest: str) -> int:
    """Number of files that were landed in a folder."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(dest)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(st.getPath().getName().startswith("part-") for st in fs.listStatus(folder))


def land_event_arrivals(spark: SparkSession, sf_dir: str, dest: str, ts: F.Column, arrivals: int = 8) -> str:
    """Write the events (event_id, user_id, event_type, event_timestamp = ``ts``)
    as arrivals, one Parquet file each: equal ranges of event ids, at least
    ``arrivals`` and as many more as their rows ask for."""
    e = table(spark, sf_dir, "events")
    b = e.agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("top")).first()
    k = max(arrivals, -(-b["n"] // ARRIVAL_ROWS))
    arrival = F.expr(f"event_id * {k} div {(b['top'] or 0) + 1}")
    (e.select("event_id", "user_id", "event_type", ts.cast("timestamp").alias("event_timestamp"), arrival.alias("arrival"))
     .repartition(k, "arrival").write.partitionBy("arrival").parquet(dest))
    _order_files(spark, dest)
    return dest


def land_in_order(rows: DataFrame, dest: str, number: str, arrivals: int, n: int) -> int:
    """Write rows as ``arrivals`` arrivals, those numbered 0, 1, ... in column
    ``number``, in one pass; one of ``n`` rows in all has as many files as its
    share asks for. Returns the files of an arrival."""
    parts = max(1, -(-n // (arrivals * ARRIVAL_ROWS)))
    piece = F.pmod(F.xxhash64(*[c for c in rows.columns if c != number]), F.lit(parts))
    (rows.withColumn("arrival", F.col(number).cast("long") * parts + piece).drop(number).repartition(arrivals * parts, "arrival")
     .write.partitionBy("arrival").parquet(dest))
    _order_files(rows.sparkSession, dest)
    return parts


def transaction_csv_lines(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Purchases rendered as CSV text lines (no header), column ``value``;
    timestamps to the second, currency padded with blanks. With ``faults``
    every DUPLICATE_EVERY-th purchase is delivered again 1 s later with
    amount + 1."""
    p = (table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
         .select("event_id", "user_id", "ts", "value"))
    if faults:
        retry = (p.filter(F.col("event_id") % DUPLICATE_EVERY == 0)
                 .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
                 .withColumn("value", F.col("value") + F.lit(1.0)))
        p = p.unionByName(retry)
    ts = F.col("ts").cast("timestamp")
    return p.select(F.concat_ws(
        ",",
        F.col("event_id").cast("string"), session_key(F.col("user_id"), ts),
        F.col("user_id").cast("string"), F.format_string("%.2f", "value"),
        F.lit(f" {CURRENCY} "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    ).alias("value"))


def user_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users rendered as CSV text lines (no header), column ``value``."""
    u = app_users(spark, sf_dir)
    return u.select(F.concat_ws(
        ",",
        F.col("user_id").cast("string"),
        F.coalesce(F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss"), F.lit("")),
        F.concat(F.lit(" "), "device_type"), F.concat("country", F.lit(" ")),
    ).alias("value"))
