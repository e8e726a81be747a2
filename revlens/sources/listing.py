"""Names and sizes of files as a table, listed by tasks; and files written by tasks, one per row.

Spark's own readers know the files of a folder on the driver.  Here the driver lists
the upper folders only, until there are enough for the tasks, and deals out what it found; each task
lists its folders with all below them.  The tasks are as many as the cluster works off quickly, not as the folders.  File systems are those pyarrow knows (local, hdfs, s3, gs, abfs).
"""

import sys
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders that the driver lists itself.
LISTED_FIRST = 64
#: Tasks per core.
TASKS_PER_CORE = 4
#: Files of a batch.
BATCH = 10_000

# Workers get the classes themselves, so they need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Folders(InputPartition):
    """Folders as pairs of a path and whether all below it counts too."""

    def __init__(self, folders: list[tuple[str, bool]]):
        self.folders = folders


class ListingReader(DataSourceReader):
    def __init__(self, path: str, glob: str, tasks: int):
        self.path, self.glob, self.tasks = path, glob, tasks

    def partitions(self):
        system, root = opened(self.path)
        if system.get_file_info(root).type != fs.FileType.Directory:
            raise ValueError(f"{self.path} is not a folder")
        waiting, listed = [root], []
        while waiting and len(listed) < LISTED_FIRST:
            folder = waiting.pop(0)
            listed.append((folder, False))
            found = system.get_file_info(fs.FileSelector(folder))
            waiting += sorted(f.path for f in found if f.type == fs.FileType.Directory)
        found = [*listed, *[(path, True) for path in waiting]]
        return [Folders(found[i :: self.tasks]) for i in range(min(self.tasks, len(found)))]

    def read(self, partition):
        system, _ = opened(self.path)
        kept = []
        for path, deep in partition.folders:
            kept += [
                (f.path, f.size)
                for f in system.get_file_info(fs.FileSelector(path, recursive=deep))
                if f.type == fs.FileType.File and fnmatch(f.base_name, self.glob) and f.base_name[0] not in "._"
            ]
            while len(kept) >= BATCH:
                yield _batch(kept[:BATCH])
                kept = kept[BATCH:]
        if kept:
            yield _batch(kept)


def _batch(files: list[tuple[str, int]]) -> pa.RecordBatch:
    columns = [pa.array([path for path, _ in files], pa.string()), pa.array([size for _, size in files], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["path", "length"])


class Listing(DataSource):
    """Files below a folder: ``path`` and ``length``.  Options ``path``, ``glob`` (of the name) and ``tasks``."""

    @classmethod
    def name(cls):
        return "file_listing"

    def schema(self):
        return "path string, length long"

    def reader(self, schema):
        return ListingReader(self.options["path"], self.options.get("glob", "*"), int(self.options.get("tasks", LISTED_FIRST)))


def list_files(spark: SparkSession, path: str, glob="*") -> DataFrame:
    spark.dataSource.register(Listing)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return spark.read.format(Listing.name()).option("path", path).option("glob", glob).option("tasks", tasks).load()


def write_files(df: DataFrame, path: str, name_col="name", body_col="body") -> int:
    """Write one file per row, named by the row, below a folder; returns how many.

    Names may hold folders.  A task that runs again writes the same files again.
    """

    def write(batches):
        system, root = opened(path)
        made = set()
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{root}/{name}"
                folder = target.rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(target) as out:
                    out.write((body or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    written = df.selectExpr(f"cast({name_col} as string)", f"cast({body_col} as string)").mapInArrow(write, "n long")
    return written.groupBy().sum("n").first()[0] or 0
