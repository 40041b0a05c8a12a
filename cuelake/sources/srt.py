"""Subtitle files as sources and sinks, and the reports that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.schema import DRAFT_MAPPING, MERGE_REPORT

REPORTS = {"merges": MERGE_REPORT, "mappings": DRAFT_MAPPING}
_TIMES = r"(?U)^\s*(\d{1,2}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{1,2}:\d{2}:\d{2}[,.]\d{3})"


def decoded(content: Column) -> Column:
    """Text of a file's bytes: UTF-8 if it is valid, else Latin-1."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(F.when(F.is_valid_utf8(as_utf8), F.lit(b"")).otherwise(content), "ISO-8859-1"))


#: The characters that Windows-1252 has for the control characters of Latin-1, and those that it has none for.
_CONTROLS = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_UNUSED = "".join(c for c, own in _CONTROLS.items() if not own)


def decoded_windows(content: Column) -> Column:
    """The same with Windows-1252 as the second choice: Latin-1 with other characters for 27 bytes. With a byte that it doesn't have a file is Latin-1."""
    latin = decoded(content)
    own = F.translate(latin, "".join(c for c in _CONTROLS if c not in _UNUSED), "".join(_CONTROLS.values()))
    return F.when(F.is_valid_utf8(content.cast("string")) | latin.rlike(f"[{_UNUSED}]"), latin).otherwise(own)


_LANG = "[a-z]{2,3}(?:-[a-z0-9]{2,4})?"


def read_files(spark: SparkSession, path: str | list[str], windows: bool = False) -> DataFrame:
    """(folder, title_id, lang, content) of every .srt file: title_id is the file's name without language and ending, lang the two or three letters before the ending, with a region or script perhaps, or null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.srt").load(path)
    parts = F.split("path", "/")
    file, folder = F.element_at(parts, -1), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    lang = F.nullif(F.regexp_extract(file, rf"\.({_LANG})\.srt$", 1), F.lit(""))
    name = F.regexp_replace(file, rf"(\.{_LANG})?\.srt$", "")
    return files.select(folder.alias("folder"), name.alias("title_id"), lang.alias("lang"), (decoded_windows(F.col("content")) if windows else decoded(F.col("content"))).alias("content"))


def _file(contents: DataFrame) -> list[str]:
    """The columns that tell files apart."""
    return [c for c in contents.columns if c != "content"]


def _blocks(contents: DataFrame) -> DataFrame:
    plain = F.regexp_replace(F.regexp_replace("content", r"\r\n?", "\n"), "^﻿", "")
    cut = contents.select(*_file(contents), F.posexplode(F.split(T.strip(plain), "\n\n+")).alias("block_no", "raw"))
    block = cut.withColumn("raw", T.strip(F.col("raw"))).where("raw <> ''").withColumn("l", F.split("raw", "\n"))
    head, times = T.strip(F.element_at("l", 1)), F.try_element_at("l", F.lit(2))
    block = block.withColumn("idx", head.try_cast("int")).withColumn("start_ms", T.timecode_to_ms(F.regexp_extract(times, _TIMES, 1))).withColumn("end_ms", T.timecode_to_ms(F.regexp_extract(times, _TIMES, 2)))
    reason = F.when(F.size("l") < 2, "Insufficient lines").when(F.col("idx").isNull(), "Invalid index").when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), "Invalid timecode")
    return block.withColumn("reason", reason)


def parse(contents: DataFrame) -> DataFrame:
    """Cues of rows with a content: (title_id, pos, idx, start_ms, end_ms, text), with title_id and whatever else tells files apart. Blocks that can't be read are left out; see parse_errors."""
    good = _blocks(contents).where("reason is null")
    file = _file(contents)
    pos = F.row_number().over(Window.partitionBy(*file).orderBy("block_no")).cast("bigint")
    return good.select(*file, pos.alias("pos"), "idx", "start_ms", "end_ms", F.array_join(F.slice("l", F.lit(3), F.size("l")), "\n").alias("text"))


def parse_errors(contents: DataFrame) -> DataFrame:
    """(title_id, block_no, reason, raw) of blocks that can't be read."""
    return _blocks(contents).where("reason is not null").select(*_file(contents), "block_no", "reason", "raw")


def render(cues: DataFrame, separator: str = "\r\n", bom: bool = True) -> DataFrame:
    """(title_id, content): one file's text for each title, in file order."""
    line = F.concat_ws("\r\n", F.col("idx").cast("string"), F.concat(T.ms_to_timecode(F.col("start_ms")), F.lit(" --> "), T.ms_to_timecode(F.col("end_ms"))), F.regexp_replace("text", "\n", "\r\n"), F.lit(""))
    listed = cues.select("title_id", F.struct("pos", line.alias("b")).alias("s")).groupBy("title_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    content = F.array_join(F.transform("s", lambda x: x["b"]), separator)
    return listed.select("title_id", F.concat(F.lit("﻿" if bom else ""), content).alias("content"))


def write_files(cues: DataFrame, path: str) -> None:
    """Files of rendered titles, one folder for each title. Fails if the path exists, so nothing is overwritten."""
    render(cues).write.mode("errorifexists").partitionBy("title_id").option("lineSep", "\r\n").text(path)


def read_report(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of a 'merges' or 'mappings' JSON report, a file or what write_report writes, with title_id from the file's or its folder's name; no rows if there is none."""
    schema = REPORTS[kind]
    try:
        raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.input_file_name())
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], f"title_id string, entry_no int, {schema}")
    folder = F.url_decode(F.regexp_extract("path", "/title_id=([^/]*)/", 1))
    name = F.when(folder != "", folder).otherwise(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\..*$", ""))
    struct = ", ".join(f"{c.split(' ', 1)[0]}: {c.split(' ', 1)[1]}" for c in _columns(schema))
    return raw.select(name.alias("title_id"), F.posexplode(F.from_json("value", f"{kind} array<struct<{struct}>>")[kind]).alias("entry_no", "e")).select("title_id", "entry_no", "e.*")


def _columns(schema: str) -> list[str]:
    out, depth, now = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def read_index_list(spark: SparkSession, path: str) -> DataFrame:
    """(idx) of a JSON array, of {"unfixable_cue_indices": [..]}, or of one number a line."""
    raw = spark.read.text(path, wholetext=True)
    listed = F.coalesce(F.from_json("value", "array<int>"), F.from_json("value", "struct<unfixable_cue_indices: array<int>>")["unfixable_cue_indices"], F.transform(F.filter(F.split("value", r"\s+"), lambda x: x.rlike("^[0-9]+$")), lambda x: x.cast("int")))
    return raw.select(F.explode(listed).alias("idx")).distinct()


def write_report(rows: DataFrame, path: str, kind: str | None = None) -> None:
    """A JSON row for each finding; with a kind, 'merges' or 'mappings', one object for each title, as read_report reads it. Fails if the path exists."""
    if kind is None:
        rows.write.mode("errorifexists").json(path)
        return
    columns = [c.split(" ", 1)[0] for c in _columns(REPORTS[kind])]
    order = "output_index" if kind == "merges" else "nl_start_ms"
    listed = rows.groupBy("title_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*columns).alias("e")))), lambda x: x["e"]).alias(kind))
    listed.select("title_id", F.to_json(F.struct(kind)).alias("value")).write.mode("errorifexists").partitionBy("title_id").text(path)
