"""`.srt` files as a Spark data source, read and written.

    spark.dataSource.register(SrtFiles)
    spark.read.format("srt").load(folder)
    in_files(cues).write.format("srt").mode("append").save(folder)

Reading: every `.srt` below a folder, dealt into partitions of about `partitionBytes` by
file; a file is read by one task, as blocks depend on what stands before them. Option
`lang` reads files of one language only; their names tell, others aren't opened. Files
that are not UTF-8 are Latin-1, or windows-1252 with option `windows`. `errors` gives the
blocks that can't be read in place of cues.

Writing: one file for each title and language, `X.nl.srt` or `X.srt`, with BOM, CRLF and
blocks as players expect. Rows of a file must come together and in order (in_files sees
to that). Tasks write below a folder of their own, which no reader of `.srt` files looks
at; only when all have succeeded the files get their names. A name that is taken fails
the write before any file appears, unless the mode is overwrite, which replaces files of
the same names and leaves others. A failed or repeated task leaves nothing.

Paths are of any store that pyarrow knows (file, hdfs, s3, gs).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

CUES = "title_id string, lang string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"
ERRORS = "title_id string, lang string, block_no int, reason string, raw string"
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}

#: Bytes of files in a partition, and rows of a batch.
PARTITION_BYTES, BATCH_ROWS = 8 << 20, 10_000
UNFINISHED = "_unfinished-"

#: Title and language in a file's name: two or three letters, and perhaps a region or script.
NAME = re.compile(r"^(.*?)(?:\.([a-z]{2,3}(?:-[a-z0-9]{2,4})?))?\.srt$")
_TIMES = re.compile(r"^\s*(\d{1,2}):(\d{2}):(\d{2})[,.](\d{3})\s*-->\s*(\d{1,2}):(\d{2}):(\d{2})[,.](\d{3})", re.ASCII)
_WHOLE = re.compile(r"[+-]?\d+", re.ASCII)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def file_name(title: str, lang: str | None) -> str:
    return f"{title}.{lang}.srt" if lang else f"{title}.srt"


def decoded(raw: bytes, windows: bool = False) -> str:
    """Text of a file's bytes, as srt.decoded and srt.decoded_windows have it."""
    for encoding in ("utf-8", "cp1252") if windows else ("utf-8",):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def blocks(content: str) -> Iterator[tuple[int, str, int | None, int | None, int | None, str | None, str]]:
    """(number, raw, idx, start_ms, end_ms, reason, text) of the blocks of a file, as srt.parse and srt.parse_errors have them."""
    plain = re.sub(r"\r\n?", "\n", content).removeprefix("﻿").strip()
    for number, part in enumerate(re.split(r"\n\n+", plain)):
        raw = part.strip()
        if not raw:
            continue
        lines = raw.split("\n")
        head = lines[0].strip()
        idx = int(head) if _WHOLE.fullmatch(head) and -(2**31) <= int(head) < 2**31 else None
        met = _TIMES.match(lines[1]) if len(lines) > 1 else None
        start, end = ((((int(h) * 60 + int(m)) * 60 + int(s)) * 1000 + int(ms)) for h, m, s, ms in (met.groups()[:4], met.groups()[4:])) if met else (None, None)
        reason = "Insufficient lines" if len(lines) < 2 else "Invalid index" if idx is None else None if met else "Invalid timecode"
        yield number, raw, idx, start, end, reason, "\n".join(lines[2:])


def timecode(ms: int) -> str:
    at = max(ms, 0)
    return f"{at // 3600000:02d}:{at // 60000 % 60:02d}:{at // 1000 % 60:02d},{at % 1000:03d}"


def block(idx: int | None, start_ms: int, end_ms: int, text: str | None) -> str:
    """A block with CRLF, without the blank line after it."""
    body = (text or "").replace("\n", "\r\n")
    return f"{'' if idx is None else idx}\r\n{timecode(start_ms)} --> {timecode(end_ms)}\r\n{body}\r\n"


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class SrtReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path, self.lang = options["path"], options.get("lang")  # names of options come in lower case
        self.windows, self.errors = (options.get(k, "false").lower() == "true" for k in ("windows", "errors"))
        self.limit = int(options.get("partitionbytes", PARTITION_BYTES))
        self.shape = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in schema.fields])

    def partitions(self) -> list[Files]:
        """Files by name, as many together as are about `partitionBytes`."""
        store, at = opened(self.path)
        found = [f for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.base_name.endswith(".srt") and UNFINISHED not in f.path]
        if self.lang is not None:
            found = [f for f in found if NAME.match(f.base_name)[2] == self.lang]
        out, size = [], 0
        for f in sorted(found, key=lambda f: f.path):
            if not out or size + f.size > self.limit:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        rows: list[tuple] = []
        for path in partition.paths:
            title, lang = NAME.match(path.rsplit("/", 1)[-1]).groups()
            with store.open_input_stream(path) as stream:
                content = decoded(stream.read(), self.windows)
            pos = 0
            for number, raw, idx, start, end, reason, text in blocks(content):
                pos += reason is None
                if self.errors and reason is not None:
                    rows.append((title, lang, number, reason, raw))
                elif not self.errors and reason is None:
                    rows.append((title, lang, pos, idx, start, end, text))
                if len(rows) == BATCH_ROWS:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), self.shape.types, strict=True)], schema=self.shape)


@dataclass
class Written(WriterCommitMessage):
    """(where it was written, its name) of each file of a task."""

    files: list[tuple[str, str]]


class SrtWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.bom = options.get("bom", "true").lower() == "true"
        self.run = f"{UNFINISHED}{uuid.uuid4().hex}"
        self.named: list[str] = []

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Writes files below a folder of this attempt. Raises if rows of a file come apart or out of order."""
        store, top = opened(self.path)
        own = f"{top}/{self.run}/{uuid.uuid4().hex}"
        out, now, last, stream = [], None, None, None
        seen = set()
        try:
            for b in iterator:
                columns = {n: b.column(b.schema.get_field_index(n)).to_pylist() for n in b.schema.names}
                languages = columns.get("lang", [None] * b.num_rows)
                for title, lang, pos, idx, start, end, text in zip(*(columns[c] for c in ("title_id",)), languages, *(columns[c] for c in ("pos", "idx", "start_ms", "end_ms", "text")), strict=True):
                    if title is None or "/" in title:
                        raise ValueError(f"no file can be named after title {title!r}")
                    if (title, lang) != now:
                        if (title, lang) in seen:
                            raise ValueError(f"cues of {file_name(title, lang)} don't come together; write in_files(cues)")
                        if stream is not None:
                            stream.close()
                        now, last, name = (title, lang), None, file_name(title, lang)
                        seen.add(now)
                        if not out:
                            store.create_dir(own, recursive=True)
                        stream = store.open_output_stream(f"{own}/{name}.part")
                        stream.write(b"\xef\xbb\xbf" if self.bom else b"")
                        out.append((f"{own}/{name}.part", name))
                    if last is not None and pos < last:
                        raise ValueError(f"cues of {out[-1][1]} are out of order; write in_files(cues)")
                    stream.write((b"" if last is None else b"\r\n") + block(idx, start, end, text).encode())
                    last = pos
        finally:
            if stream is not None:
                stream.close()
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        """Gives all files their names, if none is taken and none comes twice."""
        store, top = opened(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [name for _, name in files]
        if len(set(names)) < len(names):
            raise ValueError("cues of a file were written by several tasks; write in_files(cues)")
        if not self.overwrite:
            there = {f.base_name for f in store.get_file_info(fs.FileSelector(top, allow_not_found=True))}
            if taken := sorted(there & set(names)):
                raise FileExistsError(f"{len(taken)} files exist already, among them {taken[0]}")
        for made, name in files:
            store.move(made, f"{top}/{name}")
            self.named.append(f"{top}/{name}")
        self._clear(store, top)

    def abort(self, messages: list[Written | None]) -> None:
        store, top = opened(self.path)
        if not self.overwrite:  # what a commit had named before it failed
            for path in self.named:
                store.delete_file(path)
        self._clear(store, top)

    def _clear(self, store: fs.FileSystem, top: str) -> None:
        if store.get_file_info(f"{top}/{self.run}").type == fs.FileType.Directory:
            store.delete_dir(f"{top}/{self.run}")


class SrtFiles(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "srt"

    def schema(self) -> str:
        return ERRORS if self.options.get("errors", "false").lower() == "true" else CUES

    def reader(self, schema: StructType) -> SrtReader:
        return SrtReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SrtWriter:
        return SrtWriter(dict(self.options), overwrite)


def in_files(cues: DataFrame) -> DataFrame:
    """Cues as the writer needs them: those of a file in one task and in order. Titles are what grows, so that files are dealt evenly."""
    keys = ["title_id", *(["lang"] if "lang" in cues.columns else [])]
    return cues.repartition(*keys).sortWithinPartitions(*keys, "pos")


def title_card_files(cards: DataFrame) -> DataFrame:
    """Title cards as cues of files of their own, `X.title_cards.srt`, numbered from 1 by start."""
    from cuelake.operators import timing

    own = timing.renumber(timing.reorder(cards)).drop("old_idx", "moved")
    return own.selectExpr("concat(title_id, '.title_cards') AS title_id", "pos", "idx", "start_ms", "end_ms", "text")
