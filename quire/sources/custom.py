"""K8: sinks as registered data, written through Spark's two-phase writer.

A ``Sink`` says how rows become a file's bytes. ``register_sink`` makes it a Spark data source of that name:
``df.write.format(name).mode("append").save(path)``, or ``write_articles(df, name, path=...)``. Each task writes one
file below ``_staged/<job>``; when all tasks are done, ``commit`` moves the files into place and then
names them in ``_committed/<job>.json``; a failed job's files are deleted, so a reader who goes by the
committed lists (``committed_files``) never sees part of a job. A task that is tried again writes another file, of which
only the one whose task succeeded is committed. Overwriting replaces the lists of earlier jobs.

Paths are those that pyarrow's file systems read (local and shared folders, hdfs://, s3://). A task holds
as many rows as ``Sink.rows_at_once``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass(frozen=True)
class Sink:
    """``encode`` turns some rows (dicts) into bytes; ``header`` and ``footer`` go around a file."""
    name: str
    suffix: str
    encode: Callable[[list[dict]], bytes]
    header: bytes = b""
    footer: bytes = b""
    rows_at_once: int = 1000


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class SinkWriter(DataSourceWriter):
    def __init__(self, sink: Sink, path: str, overwrite: bool):
        self.sink, self.path, self.overwrite, self.job = sink, path.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        fs, base = _open(self.path)
        name = f"part-{uuid.uuid4().hex}{self.sink.suffix}"
        batch, n, out = [], 0, None

        def put(rows: list[dict]) -> None:
            nonlocal out
            if out is None:
                fs.create_dir(f"{base}/_staged/{self.job}", recursive=True)
                out = fs.open_output_stream(f"{base}/_staged/{self.job}/{name}")
                out.write(self.sink.header)
            out.write(self.sink.encode(rows))

        try:
            for row in iterator:
                batch.append(row.asDict(recursive=True))
                n += 1
                if len(batch) >= self.sink.rows_at_once:
                    put(batch)
                    batch = []
            if batch:
                put(batch)
            if out is not None:
                out.write(self.sink.footer)
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None, n)

    def commit(self, messages) -> None:
        fs, base = _open(self.path)
        done = [m for m in messages if m is not None and m.file]
        fs.create_dir(f"{base}/_committed", recursive=True)
        earlier = [] if not self.overwrite else [i.path for i in fs.get_file_info(pafs.FileSelector(f"{base}/_committed")) if i.is_file]
        for m in done:
            fs.move(f"{base}/_staged/{self.job}/{m.file}", f"{base}/{m.file}")
        said = json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done)})
        with fs.open_output_stream(f"{base}/_committed/{self.job}.tmp") as f:
            f.write(said.encode())
        fs.move(f"{base}/_committed/{self.job}.tmp", f"{base}/_committed/{self.job}.json")
        for p in earlier:
            if p.endswith(".json"):
                fs.delete_file(p)
        self._clear(fs, base)

    def abort(self, messages) -> None:
        self._clear(*_open(self.path))

    def _clear(self, fs, base: str) -> None:
        """What this job staged and did not commit goes."""
        if fs.get_file_info(f"{base}/_staged/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/_staged/{self.job}")


SINKS: dict[str, Sink] = {}


def register_sink(spark: SparkSession, sink: Sink) -> Sink:
    """Make ``sink`` a data source of its name in this session."""
    class Source(DataSource):
        @classmethod
        def name(cls):
            return sink.name

        def writer(self, schema, overwrite):
            return SinkWriter(sink, self.options["path"], overwrite)

    spark.dataSource.register(Source)
    SINKS[sink.name] = sink
    return sink


def write_sink(rows: DataFrame, name: str, path: str, mode: str = "append") -> None:
    rows.write.format(name).mode(mode).save(path)


def committed_files(path: str) -> list[str]:
    """The files of all committed jobs."""
    fs, base = _open(path.rstrip("/"))
    if fs.get_file_info(f"{base}/_committed").type != pafs.FileType.Directory:
        return []
    out = []
    for i in sorted(fs.get_file_info(pafs.FileSelector(f"{base}/_committed")), key=lambda i: i.path):
        if i.path.endswith(".json"):
            with fs.open_input_stream(i.path) as f:
                out += [f"{base}/{x}" for x in json.loads(f.read())["files"]]
    return out


def json_lines(rows: list[dict]) -> bytes:
    return "".join(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows).encode()
