"""Entities of timed text and their fixed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One row for each cue. pos is the order in the file; idx the number it carries, which may repeat or jump.
CUE = "title_id string, lang string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string, original_text string"
SPEECH_FRAME = "title_id string, aggressiveness int, frame_idx bigint, is_speech boolean"
SPEECH_SEGMENT = "title_id string, seg_no bigint, start_ms bigint, end_ms bigint"
MERGE_REPORT = (
    "output_index int, output_start_ms bigint, output_end_ms bigint, source_indices array<int>, source_timecodes array<struct<start_ms: bigint, end_ms: bigint>>, "
    "source_count int, gap_ms bigint, combined_duration_ms bigint, text string"
)
DRAFT_MAPPING = "nl_start_ms bigint, nl_end_ms bigint, en_indices array<int>, en_start_ms bigint, en_end_ms bigint"

FRAME_MS = 30

# Limits by language and framerate.
CONSTRAINTS_SCHEMA = (
    "lang string, fps int, cps_optimal int, cps_soft_ceiling int, cps_hard_limit int, max_chars_per_line int, max_duration_ms int, min_duration_ms int, min_gap_ms int, "
    "max_words_per_min int, max_lines int, unbreak_threshold int"
)
CONSTRAINTS = [
    ("nl", 24, 11, 15, 20, 42, 7007, 833, 125, 180, 2, 40),
    ("nl", 25, 12, 17, 20, 42, 7000, 840, 120, 180, 2, 40),
    ("en", 24, 15, 20, 20, 42, 7007, 1000, 125, 180, 2, None),
    ("en", 25, 15, 20, 20, 42, 7000, 1000, 120, 180, 2, None),
]
#: Longest cue when no framerate is given.
MAX_DURATION_MS = 8000

# Merge parameters, target output/source percentages and dual-speaker percentages by genre.
GENRE_SCHEMA = "genre string, gap_threshold_ms int, max_duration_ms_24 int, max_duration_ms_25 int, ratio_lo int, ratio_hi int, dual_lo int, dual_hi int"
GENRES = [
    ("documentary", 1000, 7007, 7000, 70, 85, 0, 10),
    ("drama", 1000, 7007, 7000, 60, 75, 10, 25),
    ("comedy", 800, 6000, 6000, 55, 70, 15, 40),
    ("fast-unscripted", 500, 6000, 6000, 50, 65, 15, 40),
]


def constraints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONSTRAINTS, CONSTRAINTS_SCHEMA)


def genres(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GENRES, GENRE_SCHEMA)


def limits(lang: str = "nl", fps: int = 25) -> dict[str, int]:
    """The limits of one language and framerate by name."""
    names = [c.split()[0] for c in CONSTRAINTS_SCHEMA.split(", ")]
    return next(dict(zip(names, row, strict=True)) for row in CONSTRAINTS if row[:2] == (lang, fps))
