"""Load documents into a store batch by batch, as a data source that Spark writes to.

Every task sends its documents in batches, each under an id that is the same whenever the task is
run again. A store takes a batch whole or refuses it; a refused batch is sent again document by
document, and those refused alone are set aside with the reason the store gives. Nothing is seen
before all tasks are done: what they wrote, and the numbers of a load, come from the messages of
the attempts that Spark commits, and an aborted load is taken back.

A store is a class with the methods of :class:`FileStore`, which keeps a collection as files of
JSON lines in a folder that all executors reach. Another one is named by the option ``store`` as
``package.module:Class`` and made from the options of the write.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from reshelve.config import BATCH_SIZE, DOCUMENT_LIMIT_BYTES
from reshelve.functions.convert import convert_values
from reshelve.operators.document import MARKS, Documents
from reshelve.sinks.documents import SIZE, TOO_LARGE, TOO_MANY_ROWS, LoadCounts

FORMAT = "document_store"

# Documents that a task is handed at a time at most, however many a batch holds.
ARROW_ROWS = 200
ROW = "customer_id long, document string, whole boolean, first boolean"
REJECTED = "customer_id long, document_bytes int, reason string"


class Refused(Exception):
    """A store does not take a batch; the text is the reason."""


@dataclass
class Session:
    """What one attempt of a task writes to a file store."""

    store: FileStore
    name: str
    files: dict[str, fs.FileSystem] = field(default_factory=dict)

    def insert(self, batch: str, documents: list[tuple[int, str]]) -> None:
        """Take a batch of keys and documents whole, or refuse it."""
        for _, text in documents:
            if len(text.encode()) > self.store.limit:
                raise Refused(TOO_LARGE)
        self._append("part", [text for _, text in documents])

    def set_aside(self, rejected: list[tuple[int, int | None, str]]) -> None:
        """Keep what is refused for good: key, size and reason."""
        self._append("rejected", [json.dumps(dict(zip(
            ("customer_id", "document_bytes", "reason"), row))) for row in rejected])

    def _append(self, kind: str, lines: list[str]) -> None:
        name = f"{kind}-{self.name}.json"
        if name not in self.files:
            system, folder = self.store.system()
            self.files[name] = system.open_output_stream(f"{folder}/{name}", compression=None)
        self.files[name].write("".join(f"{line}\n" for line in lines).encode())

    def close(self) -> list[str]:
        """The names of what was written, for the commit."""
        for stream in self.files.values():
            stream.close()
        return sorted(self.files)


class FileStore:
    """A collection of JSON lines. A manifest names the files of the last committed load."""

    MANIFEST = "_committed.json"

    def __init__(self, options: dict[str, str]):
        self.path, self.load = options["path"].rstrip("/"), options["load"]
        self.limit = int(options.get("limit", DOCUMENT_LIMIT_BYTES))

    def system(self) -> tuple[fs.FileSystem, str]:
        """The file system and the folder of this load."""
        if "://" in self.path or self.path.startswith("file:"):
            system, folder = fs.FileSystem.from_uri(self.path)
        else:
            system, folder = fs.LocalFileSystem(), self.path
        system.create_dir(f"{folder}/{self.load}", recursive=True)
        return system, f"{folder}/{self.load}"

    def session(self, name: str) -> Session:
        return Session(self, name)

    def commit(self, names: list[str], counts: LoadCounts) -> None:
        """Make this load the collection, and drop the one before."""
        system, folder = self.system()
        whole = folder.rsplit("/", 1)[0]
        draft = f"{whole}/_{self.load}"
        with system.open_output_stream(draft) as stream:
            stream.write(json.dumps({"load": self.load, "files": names, "attempted":
                                     counts.attempted, "inserted": counts.inserted,
                                     "rejected": counts.rejected}).encode())
        system.move(draft, f"{whole}/{self.MANIFEST}")
        for info in system.get_file_info(fs.FileSelector(whole)):
            if info.type == fs.FileType.Directory and info.base_name != self.load:
                system.delete_dir(info.path)

    def abort(self, names: list[str]) -> None:
        """Take back what this load has written."""
        system, folder = self.system()
        system.delete_dir(folder)


@dataclass
class Loaded(WriterCommitMessage):
    """What one attempt of a task did."""

    inserted: int
    rejected: int
    names: list[str]


def _made(options: dict[str, str]):
    module, _, name = options.get("store", f"{__name__}:FileStore").partition(":")
    return getattr(importlib.import_module(module), name)(options)


class StoreWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.size = int(options.get("batchsize", BATCH_SIZE))

    def write(self, iterator: Iterator) -> Loaded:
        task = TaskContext.get()
        session = _made(self.options).session(f"{task.partitionId():06d}-{task.taskAttemptId()}")
        inserted = rejected = number = 0
        batch: list[tuple[int, str]] = []

        def send() -> None:
            nonlocal inserted, rejected, number
            name = f"{task.partitionId()}-{number}"
            number += 1
            try:
                session.insert(name, batch)
                inserted += len(batch)
            except Refused:
                aside = []
                for i, (key, text) in enumerate(batch):
                    try:
                        session.insert(f"{name}-{i}", [(key, text)])
                        inserted += 1
                    except Refused as reason:
                        aside.append((key, len(text.encode()), str(reason)))
                session.set_aside(aside)
                rejected += len(aside)
            batch.clear()

        for row in iterator:
            if row["whole"]:
                batch.append((row["customer_id"], row["document"]))
                if len(batch) >= self.size:
                    send()
            elif row["first"]:
                session.set_aside([(row["customer_id"], None, TOO_MANY_ROWS)])
                rejected += 1
        if batch:
            send()
        return Loaded(inserted, rejected, session.close())

    def commit(self, messages: list[Loaded | None]) -> None:
        done = [m for m in messages if m is not None]
        inserted, rejected = (sum(getattr(m, n) for m in done) for n in ("inserted", "rejected"))
        _made(self.options).commit(sorted(n for m in done for n in m.names),
                                    LoadCounts(inserted + rejected, inserted, rejected))

    def abort(self, messages: list[Loaded | None]) -> None:
        _made(self.options).abort([n for m in messages if m is not None for n in m.names])


class StoreSource(DataSource):
    """The data source ``document_store``; it is only written to."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROW

    def writer(self, schema: T.StructType, overwrite: bool) -> StoreWriter:
        if not overwrite:
            raise ValueError("a collection is replaced as a whole: use the mode overwrite")
        return StoreWriter({k.lower(): v for k, v in self.options.items()})


@contextmanager
def _arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand tasks so many rows at a time, which they hold as Arrow and as Python objects."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def load_collection(docs: Documents, path: str, limit: int = DOCUMENT_LIMIT_BYTES,
                    batch_size: int = BATCH_SIZE, store: str | None = None,
                    options: dict[str, str] | None = None) -> LoadCounts | None:
    """Replace a collection with these documents, in one pass over them.

    Pieces of customers with more rows than a document can have are set aside unseen. The numbers
    are those of the committed tasks; a store of another kind keeps its own.
    """
    spark = docs.pieces.sparkSession
    spark.dataSource.register(StoreSource)
    pieces = convert_values(docs.pieces)
    fields = [c for c in pieces.columns if c not in MARKS]
    # Pieces that are set aside need not be turned into text.
    text = F.when(F.col("whole"), F.to_json(F.struct(*fields)))
    rows = pieces.select(F.col("customer_id").cast("long").alias("customer_id"),
                         text.alias("document"), "whole", "first")
    given = {"path": path, "load": uuid.uuid4().hex, "limit": str(limit),
             "batchSize": str(batch_size), **({"store": store} if store else {}), **(options or {})}
    with _arrow_rows(spark, min(batch_size, ARROW_ROWS)):
        try:
            rows.write.format(FORMAT).options(**given).mode("overwrite").save()
        except Py4JJavaError as error:  # several stages failed at once, which has no class of its own
            raise PySparkException(str(error.java_exception)) from error
    return None if "store" in given else collection_counts(path)


def _manifest(path: str) -> dict:
    store = FileStore({"path": path, "load": ""})
    system, folder = store.system()
    with system.open_input_stream(f"{folder.rstrip('/')}/{FileStore.MANIFEST}") as stream:
        return json.loads(stream.read())


def collection_counts(path: str) -> LoadCounts:
    """What the last committed load of a file store did."""
    held = _manifest(path)
    return LoadCounts(held["attempted"], held["inserted"], held["rejected"])


def read_collection(spark: SparkSession, path: str, schema: T.StructType) -> tuple[Documents, DataFrame]:
    """The documents of a file store, and what its last load set aside."""
    held = _manifest(path)
    files = {kind: [f"{path}/{held['load']}/{n}" for n in held["files"] if n.startswith(kind)]
             for kind in ("part", "rejected")}

    def read(names: list[str], kind) -> DataFrame:
        return spark.read.schema(kind).json(names) if names else spark.createDataFrame([], kind)

    marks = {"whole": F.lit(True), "first": F.lit(True), "carried": F.lit(False)}
    return (Documents(read(files["part"], schema).withColumns(marks)),
            read(files["rejected"], REJECTED).withColumnRenamed("document_bytes", SIZE))
