"""Incremental ingest: a drop folder as a stream, settled files, one good or failed row for each document, idempotent outputs by batch."""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType


def watch_folder(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """New files of a drop folder; the query's checkpoint remembers which were seen.

    With ``archive``, a folder outside the drop folder, files of finished batches move there.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def settled(rows: DataFrame, now: Column, seconds: int = 300, mtime: str = "mtime") -> DataFrame:
    """Rows of files that have not changed for a while."""
    return rows.where(F.col(mtime) <= now - F.make_interval(secs=F.lit(seconds)))


def _table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def hold_until_settled(held: str, outputs: Callable[[DataFrame, int], None], now: Callable[[], Column] = F.current_timestamp, seconds: int = 300, mtime: str = "mtime") -> Callable[[DataFrame, int], None]:
    """Batches in which rows of files that are not settled yet wait in the folder ``held`` and go on with a later batch.

    Each batch writes what it holds back under its own number and reads that of the batch before, so a
    repeated batch does the same again. Call the result with an empty batch to release what is held when no files come.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        waiting = rows.unionByName(_table(rows.sparkSession, f"{held}/batch={batch_id - 1}", rows.schema))
        ripe = F.coalesce(F.col(mtime) <= now() - F.make_interval(secs=F.lit(seconds)), F.lit(True))
        waiting.where(~ripe).write.mode("overwrite").parquet(f"{held}/batch={batch_id}")
        outputs(waiting.where(ripe), batch_id)

    return write


#: What is kept of a bucket of documents, see :func:`_packed`.
_HELD = "documents binary"


def _packed(documents: dict[str | None, list]) -> bytes:
    """Documents by key: when each was last changed, its last row, and null; or, once it has gone on, two nulls and when it is forgotten."""
    return zlib.compress(json.dumps([[k, *d] for k, d in documents.items()], ensure_ascii=False, separators=(",", ":")).encode(), 1)


def _unpacked(held: bytes) -> dict[str | None, list]:
    return {k: d for k, *d in json.loads(zlib.decompress(held))}


def _advanced(documents: dict[str | None, list], rows: Iterable[tuple[str | None, int, str]], now: int, wait: int, forget: int) -> tuple[list[str], dict[str | None, list], int | None]:
    """A bucket after new (key, time of change, row): the rows that go on now, what is kept, and when the next of it is due. Milliseconds."""
    for k, at, row in rows:
        held = documents.get(k)
        if held and held[1] is None:
            held[2] = now + forget
        elif not held or (at, row) > (held[0], held[1]):
            documents[k] = [at, row, None]
    ripe, kept, timer = [], {}, None
    for k, (at, row, until) in documents.items():
        if row is not None and at + wait <= now:
            ripe.append(row)
            at, row, until = None, None, now + forget
        due = until if row is None else at + wait
        if due > now:
            kept[k] = [at, row, until]
            timer = due if timer is None else min(timer, due)
    return ripe, kept, timer


def settle_once(stream: DataFrame, key: str, mtime: str = "mtime", seconds: int = 300, forget: int = 86_400, buckets: int = 8192) -> DataFrame:
    """A stream's documents, each once and as last delivered, when they have not changed for ``seconds``.

    A document's last row waits until that long after its time of change; a later delivery before that sets the time anew, and one after the release is a
    repeat and goes, until ``forget`` seconds without one have passed. Timers go by the clock, so held documents are released when no files come. A null
    time of change counts as settled; rows with a null key are one document; of equal times the greatest row counts.

    State is kept for buckets of documents, by the hash of their key, with a timer for the earliest of each: what a document costs is its share of a bucket, not
    a state and a call of its own, and of one that has gone on only its key is kept. A batch rewrites the buckets that it has documents of.
    """
    name = F.col(key).cast("string")
    changed = F.coalesce(F.unix_millis(F.col(mtime).cast("timestamp")), F.lit(0))
    told = stream.select(F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int").alias("bucket"), name.alias("key"), changed.alias("mtime"), F.to_json(F.struct("*")).alias("row"))

    def step(_bucket, frames, state):
        now = state.getCurrentProcessingTimeMs()
        documents = _unpacked(state.get[0]) if state.exists else {}
        rows = () if state.hasTimedOut else (r for f in frames for r in zip(f["key"].tolist(), f["mtime"].tolist(), f["row"].tolist(), strict=True))
        ripe, kept, timer = _advanced(documents, rows, now, seconds * 1000, forget * 1000)
        if kept:
            state.update((_packed(kept),))
            state.setTimeoutDuration(timer - now)
        elif state.exists:
            state.remove()
        if ripe:
            yield pd.DataFrame({"row": ripe})

    out = told.groupBy("bucket").applyInPandasWithState(step, "row string", _HELD, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return out.select(F.from_json("row", stream.schema).alias("r")).select("r.*")


def isolate(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and failed ones with the names of the checks that did not hold as ``error``."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    marked = rows.withColumn("error", F.array_join(failed, ","))
    return marked.where("error = ''").drop("error"), marked.where("error <> ''")


def count_errors(rows: DataFrame, errors: dict[str, Column], name: str = "errors") -> tuple[DataFrame, Observation]:
    """The rows as they are, and an observation that holds, once they have been written, how many there were (``rows``) and how many had each error (a column that is null where all is well).

    Counted in the pass that writes, not in one of its own.
    """
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(e) for e, c in errors.items()]), seen


def drop_repeats(stream: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """A document delivered again within the watermark is dropped; NTZ timestamps become timestamps first."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def run_batches(stream: DataFrame, outputs: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Hand each batch to ``outputs(rows, batch_id)``, which must overwrite what it wrote for that batch before; all there is ``once``, or for ever.

    A stream with timers by the clock, as :func:`settle_once` makes, always has another batch to look at them: it is not for ``once``.
    """
    writer = stream.writeStream.foreachBatch(outputs).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def drain(query: StreamingQuery, seconds: int = 600) -> None:
    """Let a query with timers by the clock run until a batch has found no new rows, then stop it; it gives up when for ``seconds`` no batch has run. How long batches take depends on the rows that there are."""
    end, done = time.monotonic() + seconds, 0
    try:
        while query.isActive and time.monotonic() < end and not any(p["numInputRows"] == 0 for p in query.recentProgress):
            if query.status["isTriggerActive"] or len(query.recentProgress) != done:
                end, done = time.monotonic() + seconds, len(query.recentProgress)
            time.sleep(0.2)
        if query.exception():
            raise query.exception()
        if time.monotonic() >= end:
            raise TimeoutError(f"no batch for {seconds} s")
    finally:
        query.stop()


def batch_outputs(path: str, checks: dict[str, Column], name: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Good rows as JSON, failed rows, the ledger and a summary of each batch, under its number: a repeated batch replaces its own output.

    ``name`` is the document's name in the ledger, ``file_name`` by default.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        good, failed = isolate(rows, checks)
        good.write.mode("overwrite").json(f"{path}/good/batch={batch_id}")
        failed.write.mode("overwrite").parquet(f"{path}/failed/batch={batch_id}")
        file_name = (F.col("file_name") if name is None else name).cast("string").alias("file_name")
        entry = lambda df, status: df.select(F.lit(batch_id).cast("long").alias("run"), file_name, F.lit(f"{path}/{'good' if status == 'done' else 'failed'}").alias("path"), F.lit(status).alias("status"))
        entry(good, "done").unionByName(entry(failed, "failed")).write.mode("overwrite").parquet(f"{path}/ledger/batch={batch_id}")
        ledger = rows.sparkSession.read.parquet(f"{path}/ledger/batch={batch_id}")
        ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/summary/batch={batch_id}")

    return write
