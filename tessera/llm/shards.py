"""What writers of binary shards share: paths in any store, commit by rename, range partitions."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Input bytes (as Spark's plan estimates them) for one output partition.
PARTITION_BYTES = 16 << 20
#: Spark's estimate for rows of unknown size is a share of the largest long.
UNKNOWN_BYTES = 1 << 60


def store_of(url: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URL or an absolute path."""
    return fs.FileSystem.from_uri(url if "://" in url or url.startswith("file:") else f"file://{url}")


class Committed:
    """A file that appears under its name only when it is whole, and stays from then on.

    The name is the same for every attempt of a task and the bytes are too, so a later
    attempt leaves a file that is there as it is: at no moment is a committed file absent.
    """

    def __init__(self, folder: str, name: str):
        self.store, root = store_of(folder)
        self.store.create_dir(root, recursive=True)
        self.path, self.temporary = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        if self._there(self.path):
            self.store.delete_file(self.temporary)
            return
        try:
            self.store.move(self.temporary, self.path)
        except OSError:  # another attempt was first, in a store whose moves don't replace
            if not self._there(self.path):
                raise
            self.abort()

    def abort(self) -> None:
        self.out.close()
        if self._there(self.temporary):
            self.store.delete_file(self.temporary)

    def _there(self, path: str) -> bool:
        return self.store.get_file_info(path).type != fs.FileType.NotFound


def new_folder(url: str) -> None:
    """Refuse a folder that holds files: what a task finds there can only be its own earlier attempt's."""
    store, root = store_of(url)
    if store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        raise FileExistsError(f"{url} is not empty")


def partitions_for(df: DataFrame) -> int:
    """Output partitions in proportion to the input's size, so that one holds about PARTITION_BYTES.

    Rows without a file behind them have no known size: for those, the session's number of shuffle partitions.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // PARTITION_BYTES))


def range_sorted(df: DataFrame, key: str, tie: str) -> DataFrame:
    """Rows in ascending order of key (nulls first), then tie, over the partitions and within each."""
    first = F.col(key).asc_nulls_first()
    return df.repartitionByRange(partitions_for(df), first).sortWithinPartitions(first, tie)


def one_task_each(manifest: DataFrame) -> DataFrame:
    """The manifest's rows, dealt out so that about each is a task of its own."""
    return manifest.repartition(max(1, manifest.count()))
