"""Report objects: for each title one JSON object with settings, summary and what was found.

A title's rows are gathered, as a file of them would be; titles are dealt. Rows keep the
order of cues. Objects without rows still have their summary and an empty list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cuelake.operators import stats

#: What a reader expects of each kind: the name of the list, its rows, and the figures of the summary.
KINDS = {
    "trim": ("trims", "cue_num int, old_end bigint, new_end bigint, action string, trim_ms bigint, method string", "total_cues bigint, full_trims bigint, partial_trims bigint, skipped bigint, total_trim_ms bigint, skip_reasons map<string, bigint>"),
    "timing": (
        "flagged",
        "cue_num int, issues array<struct<type: string, severity: string>>, end_delta_ms bigint, start_delta_ms bigint",
        "cues_analyzed bigint, cues_flagged bigint, high bigint, medium bigint, low bigint, anticipation_ideal bigint, anticipation_missing bigint, anticipation_flagged bigint, end_delta_avg_ms bigint, start_delta_avg_ms bigint",
    ),
    "extension": ("extensions", "cue_num int, old_end bigint, new_end bigint, extension_ms bigint", "total_cues bigint, extended_cues bigint, total_extension_ms bigint"),
    "validation": ("findings", "cue_num int, code string, severity string, line_no int, value bigint", "valid boolean, total_cues bigint, error_count bigint, warning_count bigint"),
}


def _listed(kind: str) -> Column:
    """What is gathered of a row: its place, and the columns of the list."""
    return F.struct("pos", F.struct(*(F.col(c).cast(t).alias(c) for c, t in _fields(KINDS[kind][1]))).alias("e"))


def _gathered(kind: str, summary: DataFrame, rows: DataFrame) -> DataFrame:
    """A summary with the rows of its titles; rows have title_id, pos and the columns of the list."""
    return summary.join(rows.groupBy("title_id").agg(F.array_sort(F.collect_list(_listed(kind))).alias("rows")), "title_id", "left")


def _object(kind: str, own: DataFrame, settings: dict | None) -> DataFrame:
    """(title_id, value) of titles with the figures of the summary and rows, as _listed has them."""
    name, _, figures = KINDS[kind]
    own = own.select("title_id", F.struct(*(F.col(c).cast(t).alias(c) for c, t in _fields(figures))).alias("summary"), F.coalesce(F.transform("rows", lambda x: x["e"]), F.array()).alias(name))
    told = [F.struct(*(F.lit(v).alias(k) for k, v in settings.items())).alias("settings")] if settings else []
    return own.select("title_id", F.to_json(F.struct(*told, "summary", name)).alias("value"))


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)]


def trim(decisions: DataFrame, settings: dict | None = None) -> DataFrame:
    """The report of speech.trim: cues that were trimmed, and why the others were not."""
    named = decisions.withColumnsRenamed({"idx": "cue_num", "old_end_ms": "old_end", "new_end_ms": "new_end"})
    own = stats.trim_counts(named, _listed("trim"))
    why = F.map_from_entries(F.array_sort(F.transform("reasons", lambda r: F.struct(r["reason"], -r["n"]))))
    return _object("trim", own.withColumn("skip_reasons", F.when(F.size("reasons") > 0, why)), settings)


def timing(analyzed: DataFrame, issues: DataFrame, settings: dict | None = None) -> DataFrame:
    """The report of speech.analyze and speech.issues: flagged cues with their issues."""
    names = {"analyzed": "cues_analyzed", "flagged": "cues_flagged", "ideal": "anticipation_ideal", "without": "anticipation_missing", "missing": "anticipation_flagged", "end_delta_avg": "end_delta_avg_ms", "start_delta_avg": "start_delta_avg_ms"}
    found = issues.groupBy("title_id", "pos").agg(F.array_sort(F.collect_list(F.struct("type", "severity"))).alias("issues"))
    flagged = analyzed.join(found, ["title_id", "pos"]).withColumnRenamed("idx", "cue_num")
    return _object("timing", _gathered("timing", stats.timing_quality(analyzed, issues).withColumnsRenamed(names), flagged), settings)


def extension(cues: DataFrame, extended: DataFrame, settings: dict | None = None) -> DataFrame:
    """The report of speech.extend."""
    named = extended.withColumnsRenamed({"idx": "cue_num", "old_end_ms": "old_end", "new_end_ms": "new_end"})
    return _object("extension", stats.extensions(cues, named, _listed("extension")), settings)


def validation(cues: DataFrame, violations: DataFrame, drift: DataFrame | None = None, parse_errors: DataFrame | None = None, settings: dict | None = None) -> DataFrame:
    """The report of rules.violations. Runs that drift and blocks that could not be read count in the summary."""
    return _object("validation", _gathered("validation", stats.summary(cues, violations, drift, parse_errors), violations.withColumnRenamed("idx", "cue_num")), settings)


def write(objects: DataFrame, path: str) -> None:
    """One object a title below `path`, which must not exist, each a file in a folder of its own."""
    objects.write.mode("errorifexists").partitionBy("title_id").text(path)


def write_lines(objects: DataFrame, path: str) -> None:
    """One object a title below `path`, which must not exist, each a line with its title in it: files are as many as tasks, not as titles."""
    title = F.regexp_replace(F.to_json(F.struct("title_id"), {"ignoreNullFields": "false"}), r"\}$", ",")
    objects.select(F.concat(title, F.substr("value", F.lit(2)))).write.mode("errorifexists").text(path)


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(title_id, the summary's figures, the list) of objects that write has written, or of files title.json."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.input_file_name())
    folder = F.url_decode(F.regexp_extract("path", "/title_id=([^/]*)/", 1))
    title = F.when(folder != "", folder).otherwise(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\..*$", ""))
    return raw.select(title.alias("title_id"), F.from_json("value", _shape(kind)).alias("o")).select("title_id", "o.summary.*", f"o.{KINDS[kind][0]}")


def read_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The same of objects that write_lines has written. Raises if a line is none."""
    raw = spark.read.schema(f"title_id string, {_shape(kind)}").option("mode", "FAILFAST").json(path)
    return raw.select("title_id", "summary.*", KINDS[kind][0])


def _shape(kind: str) -> str:
    name, listed, figures = KINDS[kind]
    return f"summary struct<{_typed(figures)}>, {name} array<struct<{_typed(listed)}>>"


def _typed(ddl: str) -> str:
    return ", ".join(f"{c}: {t}" for c, t in _fields(ddl))

