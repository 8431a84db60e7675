"""Loads into the layered tables: raw text -> silver -> gold.

``run_medallion`` takes one load of raw text, ``merge_load`` one load of
cleaned rows (a batch load and a stream's micro-batch use the same code).
A load may come again, hold corrections, or be late:

* silver is merged by key (newest copy of an event or purchase, latest
  signup of a user), never replaced;
* rules are checked on the cleaned rows before any silver table changes, on
  the recomputed sessions before gold changes;
* gold is recomputed only for the sessions that the load touches: those of
  its events, purchases and users, and those that older copies of its events
  and purchases belong to. Key indexes of silver and gold name the dates that
  can hold them, and only those are read; purchases and users are
  semi-joined to them first. A touched session that
  has no event left is deleted from gold.

A plain function, no scheduler: the three cleaned inputs are written as
concurrent Spark jobs; what is written for one load only is deleted at its end.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import paths as session_paths
from strata.operators import quality as dq
from strata.operators.cleaning import split_corrupt
from strata.operators.sessions import SESSION_KEYS
from strata.plans import gold, silver
from strata.session import delete_path, new_path
from strata.sources.readers import parse_csv_lines, parse_json_lines, table_exists
from strata.sources.schemas import CORRUPT_COL, RAW_EVENT, RAW_TRANSACTION, RAW_USER
from strata.tables import writes

AUDIT = "processing_timestamp"
MAX_SESSION_EVENTS = 2_000_000     # events of one session, whose ordered path is one array


@dataclass(frozen=True)
class Spec:
    """How a silver table is keyed and laid out."""
    keys: tuple
    order_col: str
    partition_col: str | None = None


SILVER = {
    "events_clean": Spec(("event_id",), "event_timestamp", "event_date"),
    "transactions_clean": Spec(("transaction_id",), "transaction_timestamp", "transaction_date"),
    "users_dim": Spec(("user_id",), "signup_date"),
}
GOLD = "user_session_analysis"


@dataclass
class LoadResult:
    paths: dict
    counts: dict = field(default_factory=dict)
    touched_dates: list = field(default_factory=list)


def table_paths(base: str) -> dict:
    return {k: f"{base.rstrip('/')}/{k}" for k in (*SILVER, GOLD, "quarantine")}


def silver_rules(name: str, allowed_event_types=None) -> list:
    """Checked on a load's cleaned rows before silver changes."""
    rules = {
        "events_clean": [dq.is_unique("event_id"), dq.is_complete("user_id"), dq.is_complete("session_id")],
        "transactions_clean": [dq.is_unique("transaction_id"), dq.is_complete("user_id"), dq.min_value("amount", 0)],
        "users_dim": [dq.is_unique("user_id"), dq.is_complete("user_id")],
    }[name]
    if name == "events_clean" and allowed_event_types is not None:
        rules.append(dq.values_in("event_type", allowed_event_types))
    return rules


def _observed_write(df: DataFrame, path: str, name: str) -> int:
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return int(obs.get["rows"])


def _each(frames: dict, job) -> dict:
    """``job(name, frame)`` of independent tables as concurrent Spark jobs
    (one driver thread each); the first failure is raised."""
    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = {n: pool.submit(job, n, df) for n, df in frames.items()}
        return {n: f.result() for n, f in futures.items()}


def _dated(name: str, df: DataFrame) -> DataFrame:
    spec = SILVER[name]
    return df.withColumn(spec.partition_col, F.to_date(spec.order_col)) if spec.partition_col else df


def _read(spark: SparkSession, paths: dict, name: str) -> DataFrame | None:
    """A table, or None before its first row."""
    part = "session_date" if name == GOLD else SILVER[name].partition_col
    path = paths.get(name)
    if path is None or not table_exists(spark, path) or part and not writes.list_partitions(spark, path, part):
        return None
    return spark.read.parquet(path)


def _found_in(spark: SparkSession, paths: dict, rows: dict) -> dict:
    """Name -> partitions of a silver table that can hold older copies of
    the load's rows, by its key index (None before its first row)."""
    return _each({n: df for n, df in rows.items() if SILVER[n].partition_col},
                 lambda n, df: writes.may_hold(spark, paths[n], df, SILVER[n].keys) if _read(spark, paths, n) is not None else None)


def _touched_sessions(spark: SparkSession, paths: dict, rows: dict, found_in: dict) -> DataFrame:
    """Session keys whose gold row may change; see the module's text."""
    found = []
    for name in ("events_clean", "transactions_clean"):
        if name in rows:
            found.append(rows[name].select(*SESSION_KEYS))
            if found_in[name]:
                key = list(SILVER[name].keys)
                old = _read(spark, paths, name).filter(writes.in_partitions(SILVER[name].partition_col, found_in[name]))
                found.append(old.select(*key, *SESSION_KEYS).join(rows[name].select(*key), key, "left_semi").select(*SESSION_KEYS))
    sessions = _read(spark, paths, GOLD)
    if "users_dim" in rows and sessions is not None:
        found.append(sessions.select(*SESSION_KEYS).join(rows["users_dim"].select("user_id"), "user_id", "left_semi"))
    if not found:
        return spark.createDataFrame([], "session_id string, user_id string")
    return reduce(DataFrame.unionByName, found).distinct()


def _event_dates(spark: SparkSession, paths: dict, rows: dict, touched: DataFrame, gold_in: set | None) -> list:
    """Silver's event dates that can hold events of the touched sessions: the
    load's own, and those inside the spans of the sessions' current gold rows
    (after a completed load a gold row spans all its session's events that
    have a time). Spans are reduced to the last end per start date and held
    against silver's list of partitions, so a stray date costs nothing."""
    part = SILVER["events_clean"].partition_col
    own = rows["events_clean"].select(part) if "events_clean" in rows else None
    dates = {str(r[0]) for r in own.filter(F.col(part).isNotNull()).distinct().collect()} if own is not None else set()
    sessions = _read(spark, paths, GOLD)
    if gold_in:
        sessions = sessions.filter(writes.in_partitions("session_date", gold_in))
        spans = (sessions.select(*SESSION_KEYS, F.to_date("session_start_time").alias("a"), F.to_date("session_end_time").alias("z"))
                 .join(touched, SESSION_KEYS, "left_semi").groupBy("a").agg(F.max("z").alias("z"))
                 .filter("a IS NOT NULL").collect())                     # a row per date
        held = writes.list_partitions(spark, paths["events_clean"], part)
        dates |= {d for d in held if any(str(r["a"]) <= d <= str(r["z"]) for r in spans)}
    return sorted(dates | {writes._NULL_PARTITION})


def _long_sessions(spark: SparkSession, paths: dict, events: DataFrame, longest: DataFrame, touched: DataFrame, res: LoadResult) -> DataFrame | None:
    """Touched sessions of more than MAX_SESSION_EVENTS events (None if there
    are none): their gold rows have no path; it is kept in chunks in
    ``<gold>_paths``, until a load makes the session short enough."""
    path = paths[GOLD].rstrip("/") + "_paths"
    long = longest.filter(F.col("total_events") > MAX_SESSION_EVENTS).select(*SESSION_KEYS)
    res.counts["sessions_in_chunks"] = long.count()
    if res.counts["sessions_in_chunks"] or table_exists(spark, path):
        session_paths.replace_paths(spark, path, session_paths.path_chunks(events.join(long, SESSION_KEYS, "left_semi")), touched)
    return long if res.counts["sessions_in_chunks"] else None


def merge_load(spark: SparkSession, paths: dict, events: DataFrame | None = None, transactions: DataFrame | None = None,
               users: DataFrame | None = None, gold_rules=None, allowed_event_types=None,
               sources: dict | None = None, max_session_events: int | None = None) -> LoadResult:
    """Merge one load of cleaned rows (one row per key; see ``plans.silver``)
    into the tables under ``paths``. Any of the three may be missing.

    ``sources``: name -> function returning a frame, for silver tables that
    are kept elsewhere; called once per load, so rows that arrived since the
    last one are seen. ``max_session_events``: a rule of the caller; a longer
    session stops the load before gold changes."""
    res = LoadResult(paths)
    given = {n: _dated(n, df) for n, df in zip(SILVER, (events, transactions, users), strict=True) if df is not None}
    scratch = {n: new_path(spark, n) for n in (*given, "touched", "sessions")}
    pool, indexing = ThreadPoolExecutor(max_workers=2), []
    later = lambda job: indexing.append(pool.submit(job))  # noqa: E731  silver's key indexes are written while gold is recomputed
    try:
        res.counts = _each(given, lambda n, df: _observed_write(df, scratch[n], n))
        rows = {n: spark.read.schema(df.schema).parquet(scratch[n]) for n, df in given.items()}
        _each(rows, lambda n, df: dq.fail_fast(dq.run_rules(df, silver_rules(n, allowed_event_types))))

        # kept beside gold until gold is written: a load that dies after silver
        # changed leaves its sessions to the next load
        pending = paths[GOLD].rstrip("/") + "_pending"
        found_in = _found_in(spark, paths, rows)
        found = _touched_sessions(spark, paths, rows, found_in)
        if table_exists(spark, pending):
            found = found.unionByName(spark.read.parquet(pending)).distinct()
        found.write.parquet(scratch["touched"])
        touched = spark.read.parquet(scratch["touched"])
        writes.write_replace(touched, pending)
        published = _read(spark, paths, GOLD) is not None
        gold_in = writes.may_hold(spark, paths[GOLD], touched, SESSION_KEYS) if published else None
        dates = _event_dates(spark, paths, rows, touched, gold_in)

        def merge(n: str, df: DataFrame) -> None:
            spec = SILVER[n]
            if spec.partition_col:
                writes.upsert_partitions(spark, paths[n], df, list(spec.keys), spec.partition_col,
                                         order_col=spec.order_col, ignore_changes_in=[AUDIT], written=True,
                                         indexed=True, found_in=found_in[n], later=later)
            else:
                writes.upsert_table(spark, paths[n], df, list(spec.keys), spec.order_col)

        _each(rows, merge)

        e, t, u = ((sources or {})[n]() if n in (sources or {}) else _read(spark, paths, n) for n in SILVER)
        if e is None:                        # purchases or users before the first event
            delete_path(spark, pending)
            return res
        e = e.filter(writes.in_partitions(SILVER["events_clean"].partition_col, dates)).join(touched, SESSION_KEYS, "left_semi")
        t = (t if t is not None else spark.createDataFrame([], silver.TRANSACTION_SCHEMA)).join(touched, SESSION_KEYS, "left_semi")
        u = u if u is not None else spark.createDataFrame([], silver.USER_SCHEMA)
        # the path is one array per session: that of a session too long for a row
        # is kept in chunks beside gold; nothing is cut
        longest = e.groupBy(*SESSION_KEYS).agg(F.count(F.lit(1)).alias("total_events"))
        if max_session_events is not None:
            dq.fail_fast(dq.run_rules(longest, [dq.max_value("total_events", max_session_events)]))
            long = None
        else:
            long = _long_sessions(spark, paths, e, longest, touched, res)
        recompute = partial(gold.user_session_analysis, transactions=t, users_bound=u,
                            users=u.join(touched.select("user_id").distinct(), "user_id", "left_semi"))
        fresh = recompute(e if long is None else e.join(long, SESSION_KEYS, "left_anti"))
        if long is not None:
            fresh = fresh.unionByName(recompute(e.join(long, SESSION_KEYS, "left_semi"), with_path=False))
        res.counts["gold_staged"] = _observed_write(fresh, scratch["sessions"], "sessions")
        sessions = spark.read.parquet(scratch["sessions"])
        if gold_rules is not None:
            dq.fail_fast(dq.run_rules(sessions, gold_rules(u)))
        gone = touched.join(sessions, SESSION_KEYS, "left_anti") if published else None
        res.touched_dates = writes.upsert_partitions(spark, paths[GOLD], sessions, SESSION_KEYS, "session_date",
                                                     remove=gone, ignore_changes_in=[AUDIT], written=True,
                                                     indexed=True, found_in=gold_in, later=later)
        delete_path(spark, pending)
        for job in indexing:
            job.result()
        return res
    finally:
        pool.shutdown()
        for p in scratch.values():
            delete_path(spark, p)


def run_medallion(spark: SparkSession, event_lines: DataFrame, transaction_lines: DataFrame,
                  user_lines: DataFrame, base: str, gold_rules=None, allowed_event_types=None,
                  max_corrupt_ratio: float | None = None, load: int = 1) -> LoadResult:
    """Load raw event JSON lines, transaction CSV lines and user CSV lines
    (column ``value``) into the tables under ``base``. Malformed lines of all
    three go to ``quarantine/load=<load>`` (a re-run replaces them); a share
    of malformed event lines above ``max_corrupt_ratio`` stops the load
    before silver changes."""
    paths = table_paths(base)
    scratch = {n: new_path(spark, f"{n}_bronze") for n in SILVER}
    try:
        parsed = {
            "events_clean": parse_json_lines(event_lines, "value", RAW_EVENT, CORRUPT_COL),
            "transactions_clean": parse_csv_lines(transaction_lines, "value", RAW_TRANSACTION, CORRUPT_COL),
            "users_dim": parse_csv_lines(user_lines, "value", RAW_USER, CORRUPT_COL),
        }
        # parsed once and landed: quarantine and silver read it with a pushed
        # filter on the corrupt column instead of parsing again
        read = _each(parsed, lambda n, df: _observed_write(df, scratch[n], n))
        valid, bad = {}, None
        for n in SILVER:
            valid[n], rejected = split_corrupt(spark.read.parquet(scratch[n]), CORRUPT_COL)
            rejected = rejected.select(F.col(CORRUPT_COL).alias("value"), F.lit(n).alias("source"))
            bad = rejected if bad is None else bad.unionByName(rejected)
        bad.write.mode("overwrite").partitionBy("source").text(f"{paths['quarantine']}/load={load}")
        if max_corrupt_ratio is not None:
            corrupt = spark.read.parquet(scratch["events_clean"]).filter(F.col(CORRUPT_COL).isNotNull()).count()
            if corrupt > max_corrupt_ratio * max(1, read["events_clean"]):
                raise dq.QualityError(f"{corrupt} of {read['events_clean']} event lines are malformed")
        res = merge_load(spark, paths,
                         silver.events_clean(valid["events_clean"], stamp=True, extra_cols=()),
                         silver.transactions_clean(valid["transactions_clean"], stamp=True),
                         silver.users_dim(valid["users_dim"], stamp=True), gold_rules, allowed_event_types)
        res.counts.update(events_bronze=read["events_clean"], transactions_bronze=read["transactions_clean"],
                          users_bronze=read["users_dim"])
        return res
    finally:
        for p in scratch.values():
            delete_path(spark, p)
