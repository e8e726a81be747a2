"""Keep the stored tables current from a stream of log entries."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from revlens.plans.load import ingest
from revlens.sources.commit_log import CommitLog
from revlens.sources.store import CommitStore


def append_stream(entries: DataFrame, store: CommitStore, checkpoint: str, **options) -> DataStreamWriter:
    """Append nested log entries as they arrive; every revision is stored once.

    Each micro-batch is compared with the stored revisions of its own range, so
    replays and overlapping files change nothing and no state grows with the
    stream.  The caller sets the trigger and starts the query.
    """

    def load_batch(batch: DataFrame, _batch_id: int) -> None:
        ingest(CommitLog.from_nested(batch, unique=False), store, **options)

    return entries.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
