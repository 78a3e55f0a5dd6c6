"""Price observations as a stream: late rows never win, and only changes reach the history."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGE = "medicine_id long, platform string, scraped_at timestamp, sale double, old_sale double, seq long"
KEY, NEWEST = ["medicine_id", "platform"], ["at", "seq", "sale"]
STATE = "medicine_id array<long>, platform array<string>, at array<long>, seq array<long>, sale array<double>"
#: Medicines of neighbouring ids whose states lie together, so that a group costs one call for all of them.
NEIGHBOURS = 64


def monotone(stream: DataFrame) -> DataFrame:
    """Observations (medicine_id, platform, scraped_at, seq, sale) that are strictly newer than all before of their key and change the price.

    State is one row per ``NEIGHBOURS`` medicines: for each of their platforms the newest (scraped_at, seq) and its price.
    """

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        frame["at"] = frame["scraped_at"].astype("datetime64[us]").astype("int64")
        frame["fresh"] = 1
        if state.exists:
            known = pd.DataFrame(dict(zip(KEY + NEWEST, state.get, strict=True))).astype({"sale": "float64"})
            frame = pd.concat([known.assign(fresh=0), frame], ignore_index=True)
        # The known row stands before a new one of its stamp, and what sorts before it comes too late.
        frame = frame.sort_values([*KEY, "at", "seq", "fresh"], kind="stable", ignore_index=True)
        by = frame.groupby(KEY, sort=False, dropna=False)
        frame = frame[(by["fresh"].cummin() == 0) | (by["fresh"].transform("min") == 1)]
        frame = frame.drop_duplicates([*KEY, "at", "seq"], ignore_index=True)
        frame["old_sale"] = frame.groupby(KEY, sort=False, dropna=False)["sale"].shift()
        last = frame.drop_duplicates(KEY, keep="last")
        state.update(tuple(last[c].astype(object).where(last[c].notna(), None).tolist() for c in KEY + NEWEST))
        changed = frame["old_sale"].isna() | (frame["sale"].notna() & (frame["sale"] != frame["old_sale"]))
        yield frame.loc[(frame["fresh"] == 1) & changed, [*KEY, "scraped_at", "sale", "old_sale", "seq"]].astype({"medicine_id": "int64", "seq": "int64"})

    return stream.withColumn("near", F.expr(f"medicine_id div {NEIGHBOURS}")).groupBy("near").applyInPandasWithState(step, CHANGE, STATE, "append", GroupStateTimeout.NoTimeout)


def daily_demand(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Hits per day and key, closed when the watermark passes the day's end."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("hits")).select(F.to_date("w.start").alias("day"), "event_type", "hits")


def drained(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there now into files, once, and read them: every row exactly once."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
