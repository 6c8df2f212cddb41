"""Load documents as they land. The stream's checkpoint remembers which files have been taken, and which days of each
symbol have been stored."""

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daytally.operators.maintenance import append_batch
from daytally.operators.venues import KEEP_ORDER
from daytally.schemas import LANDED_DOCUMENT_SCHEMA, RAW_COLUMNS
from daytally.sources.documents import bad_rows, landed_rows

# The reason of rows whose date lies outside the dates that the stream was asked for.
OUTSIDE = "window"
_ROW = (
    "exchange string, Symbol string, SourceURL string, Date date, ShortExemptVolume double, ShortVolume double, "
    "TotalVolume double, reason string, row string")
_ORDER = ["Date", *KEEP_ORDER, "SourceURL"]


def _settle(first: int):
    """Rows of one symbol at one venue: those with a reason as they come, of the others one per day not stored before.

    The state is the days stored, from ``first`` on: earlier ones can't come again. A symbol's rows are taken in
    parts, so that no more than one row per day is held.
    """
    def settle(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stored = set(state.get[0]) if state.exists else set()
        best = None
        for part in parts:
            faulty = part["reason"].notna()
            if faulty.any():
                yield part[faulty]
            good = part[~faulty]
            good = good[[d.toordinal() not in stored for d in good["Date"]]]
            best = good if best is None else pd.concat([best, good])
            # The largest row of a day, nulls first, as in the batch load.
            best = best.sort_values(_ORDER, na_position="first").drop_duplicates("Date", keep="last")
        days = stored | ({d.toordinal() for d in best["Date"]} if best is not None else set())
        state.update((sorted(d for d in days if d >= first),))
        if best is not None and len(best):
            yield best

    return settle


def load_landed(
    spark: SparkSession, landing: str, store: str, checkpoint: str, pull: str, quarantine: str, files_per_batch: int = 1000,
    start: str = "1900-01-01", landed: str | None = None,
) -> None:
    """Take every file that is new in ``landing`` and stop.

    Files hold one landed document per line. Rows go to the store of the daily load, under the same layout: venue,
    pull date and batch. A batch is named after the stream, whose name lives in its checkpoint, and its number; so
    a batch repeated after a failure leaves no rows twice, and a stream with a new checkpoint replaces no other's
    rows. One row is stored for each venue, symbol and day over all batches of the stream: the largest of the first batch that
    has it; the days stored are the stream's state, kept per venue and symbol in the checkpoint. Data rows that can't be
    read, or whose date is not from ``start`` to ``pull``, go to ``quarantine`` under the same names. Each batch is
    parsed once, into ``landed`` (beside the quarantine if it is not named). All folders must be folders that every executor can
    reach. Rows that another load has stored are settled when venues are combined.
    """
    into = landed or quarantine.rstrip("/") + "_landed"
    documents = (
        spark.readStream.schema(LANDED_DOCUMENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch).json(landing)
    )
    rows = landed_rows(documents).where("has_row")
    inside = F.col("Date").between(F.lit(start).cast("date"), F.lit(pull).cast("date"))
    reason = F.coalesce("reason", F.when(~inside, OUTSIDE))
    # A row that was read but is outside is quarantined by its values.
    text = F.coalesce("row", F.when(~inside, F.to_json(F.struct("Date", *KEEP_ORDER))))
    named = rows.select(*[c for c in ("exchange", "Symbol", "SourceURL", "Date", "ShortExemptVolume", "ShortVolume", "TotalVolume")],
                        reason.alias("reason"), text.alias("row"))
    settled = named.groupBy("exchange", "Symbol").applyInPandasWithState(
        _settle(date.fromisoformat(start).toordinal()), _ROW, "days array<int>", "append", GroupStateTimeout.NoTimeout)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("the stream has no name; its batches could replace another's")
        name = f"{stream}-{batch_id}"
        path = f"{into}/pull_date={pull}/batch={name}"
        # Written first: what comes of the state is worked out once for a batch.
        batch.write.mode("overwrite").parquet(path)
        told = session.read.schema(batch.schema).parquet(path)
        append_batch(told.where("reason IS NULL").select("exchange", *RAW_COLUMNS), store, pull, name)
        bad_rows(told).write.mode("overwrite").parquet(f"{quarantine}/pull_date={pull}/batch={name}")

    query = (
        settled.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
