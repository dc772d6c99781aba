"""The tree of posts as a data source of its own, for batches and streams.

``spark.read.format("posts").load(root)`` after ``register(spark)`` gives ``category, filename, text`` like ``load_posts``, but packs many
small files into partitions of ``partition_bytes``, and a filter on ``category`` keeps other folders from being read. As a
stream it gives the posts that have arrived since: files are taken in the order of (time of change, path), so a post must not get a
time that lies before one that was already taken.

The root is listed where Spark plans the read; contents are read in the tasks. Any file system that Arrow opens by its address will do.
Names that start with ``_`` or ``.`` and files of any other depth are skipped. Spark keeps the filter that a loaded table took over,
so a query that reads the tree with and without one loads it twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from corpusloom.session import ship

PARTITION_BYTES = 32 << 20
#: What opening a file costs, in bytes.
OPEN_BYTES = 16 << 10
ROWS_PER_BATCH = 512


@dataclass(frozen=True)
class Post:
    path: str
    category: str
    filename: str
    size: int
    changed: int


@dataclass
class Pack(InputPartition):
    posts: tuple[Post, ...]


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")


def list_posts(root: str, categories: Sequence[str] | None = None) -> list[Post]:
    """All posts of the tree, or those of some categories, whose folders alone are listed then."""
    system, folder = open_root(root)
    found = []
    for place in [folder] if categories is None else [f"{folder}/{c}" for c in sorted(set(categories))]:
        for info in system.get_file_info(fs.FileSelector(place, allow_not_found=categories is not None, recursive=True)):
            parts = info.path[len(folder) :].strip("/").split("/")
            if info.type == fs.FileType.File and len(parts) == 2 and not any(p.startswith(("_", ".")) for p in parts):
                found.append(Post(info.path, parts[0], parts[1], info.size or 0, info.mtime_ns or 0))
    return found


def packed(posts: Iterable[Post], partition_bytes: int) -> list[Pack]:
    """Posts in the order of their paths, cut into partitions of about ``partition_bytes``."""
    packs: list[list[Post]] = []
    room = 0
    for post in sorted(posts, key=lambda p: p.path):
        cost = post.size + OPEN_BYTES
        if not packs or cost > room:
            packs.append([])
            room = partition_bytes
        packs[-1].append(post)
        room -= cost
    return [Pack(tuple(p)) for p in packs]


def read_pack(root: str, pack: Pack) -> Iterator[pa.RecordBatch]:
    system, _ = open_root(root)
    for start in range(0, len(pack.posts), ROWS_PER_BATCH):
        part = pack.posts[start : start + ROWS_PER_BATCH]
        texts = []
        for post in part:
            with system.open_input_file(post.path) as file:
                texts.append(file.read().decode("latin-1").replace("\r\n", "\n").replace("\r", "\n"))
        yield pa.RecordBatch.from_pydict({"category": [p.category for p in part], "filename": [p.filename for p in part], "text": texts})


class PostsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.partition_bytes = options["path"], int(options.get("partition_bytes", PARTITION_BYTES))
        self.categories: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            if isinstance(one, (EqualTo, In)) and one.attribute == ("category",):
                wanted = {one.value} if isinstance(one, EqualTo) else set(one.value)
                self.categories = wanted if self.categories is None else self.categories & wanted
            else:
                yield one

    def partitions(self) -> Sequence[InputPartition]:
        return packed(list_posts(self.root, None if self.categories is None else [c for c in self.categories if c]), self.partition_bytes) or [Pack(())]

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return read_pack(self.root, partition)


class PostsStreamReader(DataSourceStreamReader):
    """An offset is the (time of change, path) of the last post that was taken."""

    def __init__(self, options: dict):
        self.root, self.partition_bytes = options["path"], int(options.get("partition_bytes", PARTITION_BYTES))

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def latestOffset(self) -> dict:
        last = max(((p.changed, p.path) for p in list_posts(self.root)), default=(-1, ""))
        return {"changed": last[0], "path": last[1]}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = (start["changed"], start["path"]), (end["changed"], end["path"])
        return packed((p for p in list_posts(self.root) if low < (p.changed, p.path) <= high), self.partition_bytes)

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return read_pack(self.root, partition)

    def commit(self, end: dict) -> None:
        pass


class PostsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "posts"

    def schema(self) -> str:
        return "category string, filename string, text string"

    def reader(self, schema) -> PostsReader:
        return PostsReader(self.options)

    def streamReader(self, schema) -> PostsStreamReader:
        return PostsStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format ``posts`` known to a session, with filters pushed down to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PostsSource)
