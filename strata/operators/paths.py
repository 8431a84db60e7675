"""Ordered session paths of any length: chunks of events, and funnels over them.

A path as one array per session needs its whole session in one task and one
row. Here the events are sorted once over all sessions by range partitioning
on (session, time, id), so that a hot session is cut by time over as many
tasks as its share of the rows, and each task packs what it holds into chunks
of at most ``CHUNK`` events of one session.

A funnel is a step automaton: in state ``s`` (steps reached) it waits for step
``s + 1``. A chunk turns every entry state into an exit state, whatever came
before it; these transition functions are composed over consecutive chunks,
``FAN`` at a time, level by level (the parallel prefix of functions), so no
task or row holds more than ``FAN`` of them for a session. Going down the same
levels gives each chunk's entry state, and with it the times of the steps.

Events without a time are in no path. Events of one time are ordered by id,
then type (nulls first); repeated events stay. Sessions with null keys are
sessions of their own. A path with no event of any step reaches 0 steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators import metrics
from strata.operators.sessions import SESSION_KEYS
from strata.session import delete_path, new_path
from strata.tables import files, writes

CHUNK = 4096                # events of a chunk
FAN = 64                    # chunks composed into one, a level
PARTS = 64                  # folders of a stored path table
_ROW_BITS = 33              # monotonically_increasing_id: partition above, row below


def path_chunks(events: DataFrame, keys=SESSION_KEYS, ts: str = "event_timestamp", event_id: str = "event_id",
                event_type: str = "event_type", chunk: int | None = None) -> DataFrame:
    """(keys..., chunk_at, events, start_time, end_time, event_types,
    event_times): chunks of at most ``chunk`` (``CHUNK``) events, ordered
    within a session by ``chunk_at``.

    The second shuffle (to pack chunks) is combined on the map side, where
    all rows of a chunk are, so it only moves finished chunks."""
    keys = list(keys)
    rows = events.filter(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_t"), F.col(event_id).alias("_id"), F.col(event_type).alias("_v"))
    order = [*keys, "_t", "_id", "_v"]
    at = F.col("_at")
    number = at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id())
              .withColumn("_block", at - number + F.floor(number / (chunk or CHUNK))))
    packed = placed.groupBy(*keys, "_block").agg(
        F.min("_at").alias("chunk_at"), F.min("_t").alias("start_time"), F.max("_t").alias("end_time"),
        F.array_sort(F.collect_list(F.struct("_at", "_t", "_v"))).alias("_rows"))
    return packed.select(*keys, "chunk_at", F.size("_rows").cast("long").alias("events"), "start_time", "end_time",
                         F.transform("_rows", lambda r: r["_v"]).alias("event_types"),
                         F.transform("_rows", lambda r: r["_t"]).alias("event_times"))


def _numbered(chunks: DataFrame, keys) -> DataFrame:
    """Chunk number and number of earlier events, from rows without paths."""
    w = Window.partitionBy(*keys).orderBy("chunk_at")
    before = F.sum("events").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return chunks.withColumn("chunk_no", (F.row_number().over(w) - 1).cast("long")).withColumn(
        "first_position", F.coalesce(before, F.lit(0)))


def path_positions(chunks: DataFrame, keys=SESSION_KEYS) -> DataFrame:
    """(keys..., position, event_type, event_time): the path as rows, from
    position 1. Offsets come from the chunks' sizes; a session's events
    meet in no task."""
    keys = list(keys)
    offsets = _numbered(chunks.select(*keys, "chunk_at", "events"), keys).select("chunk_at", *[
        F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "first_position")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = chunks.alias("c").join(offsets.alias("o"), [F.col("c.chunk_at") == F.col("o.chunk_at"), *same])
    return (joined.select(*keys, "first_position", F.posexplode(F.arrays_zip("event_types", "event_times")).alias("_i", "_e"))
            .select(*keys, (F.col("first_position") + F.col("_i") + 1).alias("position"),
                    F.col("_e.event_types").alias("event_type"), F.col("_e.event_times").alias("event_time")))


def _relevant(steps) -> Column:
    """The chunk's events of any step: array of (index, type, time)."""
    item = F.transform(F.arrays_zip("event_types", "event_times"), lambda e, i: F.struct(
        i.cast("long").alias("i"), e["event_types"].alias("v"), e["event_times"].alias("t")))
    return F.filter(item, lambda e: F.array_contains(F.array(*[F.lit(s) for s in steps]), e["v"]))


def _walk(ahead) -> Column:
    """The events of ``_items`` that reach the steps ``ahead``, one after the
    other, each at its earliest."""
    waits = F.array(*[F.lit(s) for s in ahead])
    return F.aggregate("_items", F.slice("_items", 1, 0), lambda acc, e: F.when(
        F.try_element_at(waits, F.size(acc) + 1) == e["v"], F.concat(acc, F.array(e))).otherwise(acc))


def transitions(chunks: DataFrame, steps, keys=SESSION_KEYS) -> DataFrame:
    """(keys..., chunk_at, chunk_no, first_position, next, hits): a chunk's
    transition function, ``next[s + 1]`` the exit state of entry state ``s``.
    Reads each path once; what goes on is a few numbers a chunk."""
    keys, steps = list(keys), list(steps)
    if not steps:
        raise ValueError("a funnel needs at least one step")
    n = len(steps)
    found = (chunks.select(*keys, "chunk_at", "events", _relevant(steps).alias("_items"))
             .select(*keys, "chunk_at", "events", F.array(*[_walk(steps[s:]) for s in range(n)]).alias("hits")))
    reached = F.concat(F.transform("hits", lambda h, s: (s + F.size(h)).cast("int")), F.array(F.lit(n)))
    return _numbered(found.withColumn("next", reached), keys)


def _level(level: DataFrame, keys) -> DataFrame:
    """Groups of FAN consecutive transition functions: (keys..., no, members)."""
    return level.groupBy(*keys, F.floor(F.col("no") / FAN).alias("no")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("no").alias("at"), "next"))).alias("members"))


def _compose(members: Column, n: int) -> Column:
    start = F.array(*[F.lit(s) for s in range(n + 1)])
    return F.aggregate(members, start, lambda f, g: F.transform(f, lambda s: F.element_at(g["next"], s + 1)))


def _rounds(most: int | None) -> int:
    rounds = 0
    while most:
        most, rounds = most // FAN, rounds + 1
    return rounds


def steps_reached(chunks: DataFrame, steps, keys=SESSION_KEYS) -> DataFrame:
    """(keys..., reached): the number of funnel steps each session reached,
    in order, each strictly after the one before."""
    keys = list(keys)
    level = transitions(chunks, steps, keys).select(*keys, F.col("chunk_no").alias("no"), "next")
    for _ in range(_rounds(_most(chunks, keys))):
        level = _level(level, keys).select(*keys, "no", _compose(F.col("members"), len(steps)).alias("next"))
    return level.select(*keys, F.element_at("next", 1).alias("reached"))


def _most(chunks: DataFrame, keys) -> int | None:
    """The largest chunk number: one row to the driver, keys read only."""
    return chunks.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.max("n")).first()[0]


def funnel_by_chunks(chunks: DataFrame, steps, keys=SESSION_KEYS) -> DataFrame:
    """(step, event_type, sessions), as ``metrics.funnel_from_paths``."""
    reached = steps_reached(chunks, steps, keys)
    row = reached.agg(*[F.count_if(F.col("reached") >= i + 1).alias(f"_s{i}") for i in range(len(steps))])
    items = [F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("event_type"), F.col(f"_s{i}").alias("sessions"))
             for i, s in enumerate(steps)]
    return row.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")


def funnel_of_gold(gold: DataFrame, chunks: DataFrame, steps) -> DataFrame:
    """The funnel over gold's paths and those that are kept in chunks."""
    both = metrics.funnel_from_paths(gold, steps).unionByName(funnel_by_chunks(chunks, steps))
    return both.groupBy("step", "event_type").agg(F.sum("sessions").alias("sessions"))


def write_step_times(chunks: DataFrame, steps, path: str, keys=SESSION_KEYS) -> DataFrame:
    """(keys..., step, event_type, position, reached_at) written to ``path``:
    when and at which event of its path a session reached each step."""
    spark, keys, steps = chunks.sparkSession, list(keys), list(steps)
    scratch = []

    def written(df: DataFrame, name: str) -> DataFrame:
        scratch.append(new_path(spark, name))
        df.write.parquet(scratch[-1])
        return spark.read.parquet(scratch[-1])

    try:
        base = written(transitions(chunks, steps, keys), "transitions")
        groups, level = [], base.select(*keys, F.col("chunk_no").alias("no"), "next")
        for _ in range(_rounds(base.agg(F.max("chunk_no")).first()[0])):
            groups.append(written(_level(level, keys), "level"))
            level = groups[-1].select(*keys, "no", _compose(F.col("members"), len(steps)).alias("next"))
        entry = level.select(*keys, "no", F.lit(0).alias("entry"))
        for group in reversed(groups):                      # a group's entry state -> its members' entry states
            states = F.aggregate(
                "members", F.struct(F.col("entry").alias("s"), F.expr("CAST(array() AS array<struct<no:bigint,entry:int>>)").alias("of")),
                lambda a, m: F.struct(F.element_at(m["next"], a["s"] + 1).alias("s"), F.concat(a["of"], F.array(
                    F.struct(m["at"].alias("no"), a["s"].alias("entry")))).alias("of")))
            entry = (_join_null_safe(group, entry, [*keys, "no"])
                     .select(*keys, F.explode(states["of"]).alias("_m")).select(*keys, "_m.no", "_m.entry"))
        placed = _join_null_safe(base.withColumnRenamed("chunk_no", "no"), entry, [*keys, "no"])
        hit = F.col("_h")
        out = (placed.filter(F.col("entry") < len(steps))
               .select(*keys, "first_position", "entry", F.posexplode(F.element_at("hits", F.col("entry") + 1)).alias("_i", "_h"))
               .select(*keys, (F.col("entry") + F.col("_i") + 1).alias("step"),
                       F.element_at(F.array(*[F.lit(s) for s in steps]), F.col("entry") + F.col("_i") + 1).alias("event_type"),
                       (F.col("first_position") + hit["i"] + 1).alias("position"), hit["t"].alias("reached_at")))
        writes.write_replace(out, path)
        return spark.read.parquet(path)
    finally:
        for p in scratch:
            delete_path(spark, p)


def _join_null_safe(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    named = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                         *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(named, same).drop(*[f"_r{i}" for i in range(len(keys))])


def replace_paths(spark: SparkSession, path: str, chunks: DataFrame, touched: DataFrame, keys=SESSION_KEYS) -> None:
    """In the path table at ``path``, the sessions ``touched`` get the
    chunks in ``chunks`` (or none). Only the folders that hold one of them
    are read and written, beside the table, and published by renames. Its
    sessions' keys are not null (as in silver)."""
    keys = list(keys)
    files.recover(spark, path)
    part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(PARTS)).cast("int")
    staged, fresh = new_path(spark, "paths"), files.beside(path, files.NEW)
    try:
        chunks.withColumn("part", part).write.parquet(staged)
        rows = spark.read.schema(chunks.withColumn("part", part).schema).parquet(staged)
        parts = {str(r[0]) for r in rows.select("part").distinct().collect()}                     # PARTS values at most
        if files.exists(spark, path) and writes.list_partitions(spark, path, "part"):
            held = spark.read.parquet(path)
            parts |= {str(r[0]) for r in held.select(*keys, "part").join(touched, keys, "left_semi").select("part").distinct().collect()}
            rows = rows.unionByName(held.filter(writes.in_partitions("part", parts)).join(touched, keys, "left_anti"))
        if parts:
            writes.write_partitioned(rows, fresh, "part")
            files.publish_partitions(spark, fresh, path, [f"part={p}" for p in sorted(parts)])
    finally:
        delete_path(spark, staged)
        files.remove(spark, fresh)
