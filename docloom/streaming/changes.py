"""Changes one by one: a state machine with retries and dead letters, row hashes as state, and batches that halve.

A change that fails never holds up or drops another. As a stream, each change is
a key of a state store: what failed is kept with its old and new row values and
tried again by a timer, a longer wait each time, until it is done or a dead
letter. As batches, a batch that fails is halved until the changes at fault are
alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from docloom.sources.sinks import Checkpoint, delete

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE = "change_id long, key string, op string, changed array<string>, old string, new string"
RESULT = "change_id long, key string, op string, status string, tries int, error string, old string, new string"


def change_records(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, op, changed, old and new row values as JSON, priority (delete 3, insert 2, update 1) and hash of every row that differs between two states of a table."""
    a = before.select(F.col(key).alias("__a"), F.struct(*fields).alias("__old"))
    b = after.select(F.col(key).alias("__b"), F.struct(*fields).alias("__new"))
    j = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__old.{f}").eqNullSafe(F.col(f"__new.{f}")), F.lit(f)) for f in fields]))
    op = F.when(F.col("__a").isNull(), "insert").when(F.col("__b").isNull(), "delete").otherwise("update")
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    return j.select(
        F.coalesce("__a", "__b").alias("key"), op.alias("op"), changed.alias("changed"), text("__old").alias("old"), text("__new").alias("new"),
    ).where("op <> 'update' OR size(changed) > 0").select(
        "*", F.when(F.col("op") == "delete", 3).when(F.col("op") == "insert", 2).otherwise(1).alias("priority"),
        F.md5(F.concat_ws("\x1f", "op", F.coalesce("old", F.lit("")), F.coalesce("new", F.lit("")))).alias("change_hash"))


class _Retries(StatefulProcessor):
    """One change: tried when it arrives and at each timer, gone once it is done or dead."""

    def __init__(self, handler: Callable[[Row], object], retries: int, wait_ms: int):
        self.handler, self.retries, self.wait_ms = handler, retries, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", f"tries int, {CHANGE.removeprefix('change_id long, ')}")

    def _try(self, change_id: int, change: tuple, tries: int, now: int) -> Iterator[Row]:
        key, op, changed, old, new = change
        row = Row(change_id=change_id, key=key, op=op, changed=changed, old=old, new=new)
        try:
            self.handler(row)
        except Exception as e:  # noqa: BLE001 - any failure of a change is counted and reported with it
            error = f"{type(e).__name__}: {e}"[:500]
            if tries < self.retries:
                self.waiting.update((tries, *change))
                self.handle.registerTimer(now + self.wait_ms * tries)
                return
            status = "dead"
        else:
            error, status = None, "done"
        if self.waiting.exists():
            self.waiting.clear()
        yield Row(change_id=change_id, key=key, op=op, status=status, tries=tries, error=error, old=old, new=new)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - names of the interface
        for r in rows:
            if not self.waiting.exists():  # a change sent twice is already waiting
                yield from self._try(key[0], (r.key, r.op, r.changed, r.old, r.new), 1, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.waiting.exists():
            tries, *change = self.waiting.get()
            yield from self._try(key[0], tuple(change), tries + 1, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def processed(changes: DataFrame, handler: Callable[[Row], object], retries: int = 3, wait_ms: int = 1000) -> DataFrame:
    """``RESULT`` rows of a stream of changes (columns of ``CHANGE``): done, or dead after ``retries`` tries.

    ``handler`` gets one change on an executor and raises where it fails. A run
    that stops goes on from its checkpoint with the tries that each change had.
    """
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return changes.groupBy("change_id").transformWithState(_Retries(handler, retries, wait_ms), RESULT, "Append", "ProcessingTime")


def delivered(results: DataFrame, out: str, dead: str, checkpoint: str, interval: str = "1 second"):
    """Write results to ``out`` and dead letters, with their old and new values, to ``dead``; a batch tried again replaces itself."""

    def batch(df: DataFrame, epoch: int) -> None:
        df = df.persist()
        try:
            df.where("status = 'done'").write.mode("overwrite").parquet(f"{out}/batch={epoch}")
            df.where("status = 'dead'").write.mode("overwrite").parquet(f"{dead}/batch={epoch}")
        finally:
            df.unpersist()

    return results.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


class _Hashes(StatefulProcessor):
    """The hash of a row, kept by key until the key isn't seen for as long as ``ttl_ms`` of event time."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "hash string, at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for r in sorted(rows, key=lambda r: (r.at, r.hash)):
            old = self.last.get() if self.last.exists() else None
            if old is None or old[0] != r.hash:
                yield Row(key=key[0], op="insert" if old is None else "update", hash=r.hash)
            self.last.update((r.hash, max(r.at, old[1] if old else r.at)))
            self.handle.registerTimer(r.at + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.last.exists():
            old, at = self.last.get()
            if at + self.ttl_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.last.clear()
                yield Row(key=key[0], op="delete", hash=old)

    def close(self) -> None:
        pass


def row_changes(stream: DataFrame, key: str, fields: list[str], ts: str, ttl: str = "1 day") -> DataFrame:
    """key, op (insert, update, delete), hash of a stream of row states, with one hash of state a key.

    A micro-batch touches the keys it brings and no others. A key not seen for
    ``ttl`` of event time is deleted: snapshots come at least that often.
    """
    from docloom.functions.text import change_hash

    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    seconds = int(stream.sparkSession.sql(f"SELECT timestampdiff(SECOND, TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01' + INTERVAL {ttl})").first()[0])
    rows = stream.withWatermark(ts, "0 seconds").select(F.col(key).cast("string").alias("key"), change_hash(*fields).alias("hash"), F.unix_millis(F.col(ts)).alias("at"), F.col(ts))
    return rows.groupBy("key").transformWithState(_Hashes(seconds * 1000), "key string, op string, hash string", "Append", "EventTime")


def run_changes(spark: SparkSession, changes: DataFrame, process: Callable[[DataFrame], DataFrame], state: str, order: str = "ts", key: str = "change_id",
                batch: int = 1000, retries: int = 3, since: int | None = None, dead: str | None = None) -> dict:
    """Process changes in batches by position; a batch that fails is halved, and a change that fails alone is tried ``retries`` times and named as dead.

    The changes behind the last position are dealt to batches and written once,
    each batch a folder, so a batch reads its own rows only. Progress is a
    checkpoint after each batch, so a run that stops goes on where it was; changes
    of one position are never parted from those processed. ``dead`` is a folder for
    the rows of dead changes, with all their columns and the error.
    """
    mark = Checkpoint(spark, state)
    seen = mark.load({"done": since if since is not None else None, "processed": 0, "dead": [], "tries": 0})
    todo = changes if seen["done"] is None else changes.where(F.col(order) > seen["done"])
    n = todo.count()
    if not n:
        return seen
    # ranges of positions of about a batch each; rows of one position are never in two
    ranged = todo.repartitionByRange(-(-n // batch), order).withColumn("__batch", F.spark_partition_id())
    stage = f"{state.rstrip('/')}-batches-{uuid.uuid4().hex}"
    ranged.write.partitionBy("__batch").parquet(stage)
    staged = spark.read.schema(ranged.schema).parquet(stage)
    bounds = staged.groupBy("__batch").agg(F.max(order).alias("last"), F.count("*").alias("n")).orderBy("last").collect()  # a row a batch
    names = [c for c in changes.columns]

    def attempt(part: DataFrame, n: int) -> tuple[int, list]:
        try:
            process(part).write.format("noop").mode("overwrite").save()
            return n, []
        except Exception as e:  # noqa: BLE001 - any failure of a batch is counted and narrowed down
            error = str(e).splitlines()[0][:200] if str(e) else type(e).__name__
        seen["tries"] += 1
        if n > 1:
            placed = part.withColumn("__place", F.expr(f"row_number() OVER (ORDER BY `{order}`, `{key}`)"))
            halves = ("<=", n // 2), (">", n - n // 2)
            done = [attempt(placed.where(f"__place {sign} {n // 2}").select(*names), size) for sign, size in halves]
            return done[0][0] + done[1][0], done[0][1] + done[1][1]
        for _ in range(retries - 1):
            try:
                process(part).write.format("noop").mode("overwrite").save()
                return 1, []
            except Exception as e:  # noqa: BLE001
                seen["tries"] += 1
                error = str(e).splitlines()[0][:200] if str(e) else type(e).__name__
        if dead:
            part.withColumn("error", F.lit(error)).write.mode("append").parquet(dead)
        return 0, [{"key": str(part.select(key).first()[0]), "error": error}]

    for b in bounds:
        done, failed = attempt(staged.where(F.col("__batch") == b["__batch"]).select(*names), b["n"])
        seen["processed"] += done
        seen["dead"] += failed
        seen["done"] = b["last"]
        mark.save(seen)
    delete(spark, stage)
    return seen
