"""Feeding a stream batch by batch."""

import os

from dwelltide.session import STATEFUL_SETTINGS, settings
from dwelltide.sources.streams import FLAT_EVENT

HOUR = 3_600_000


class Feed:
    """A folder of input files, one per micro-batch, read in the order they are added."""

    def __init__(self, spark, folder, schema=FLAT_EVENT):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        self.count = 0

    def add(self, *rows):
        self.count += 1
        path = f"{self.folder}/in/{self.count:04d}"
        frame = self.spark.createDataFrame(list(rows), self.schema)
        frame.coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                os.utime(f"{path}/{name}", (1_700_000_000 + self.count,) * 2)
        return self

    def hours(self, *rows):
        """Rows (device, views, hour)."""
        return self.add(*[(d, v, int(h * HOUR)) for d, v, h in rows])

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.folder}/in/*")


def run(spark, rows, mode, folder):
    """The stream to the end of the present input; rows emitted per micro-batch."""
    batches, progress = {}, []

    def collect(frame, batch_id):
        batches[batch_id] = [r.asDict() for r in frame.collect()]

    with settings(spark, STATEFUL_SETTINGS):
        query = (
            rows.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(collect)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    progress = query.recentProgress
    return [batches[i] for i in sorted(batches)], progress


def brief(emitted):
    """(device, start hour, last hour, total, views, status) of emitted rows, sorted."""
    found = []
    for row in emitted:
        status = "absorbed" if row["absorbed"] else "closed" if row["closed"] else "live"
        start = row["session_start"].timestamp() * 1000 / HOUR
        last = None if row["last_recv_ts"] is None else row["last_recv_ts"] / HOUR
        found.append((row["device_id"], start, last, row["cvt_total"], row["n_views"], status))
    return sorted(found, key=repr)
