"""Cues, two language versions and speech frames derived from the driver's tables.

Everything is integer arithmetic over `conversations`, so that SQL can repeat it. Each
conversation is a title; its turns are cut into cues of four words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.operators.timing import by_pos

#: Turns of conversations in a task: some 44,000 cues or 3 million frames. Tasks grow in number with the table, not in size.
TURNS = 2000


def tasks(turns: int, cores: int) -> int:
    """How many tasks a table of that many turns is dealt to: one for each core if it is small, but for the smallest."""
    return max(-(-turns // TURNS), min(cores, -(-turns // 100)), 1)


def base_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(title_id, pos, idx, role, marker, t, start_ms, end_ms): clean cues with running times."""
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("string").alias("title_id"), "turn", "role", "text")
    # a turn becomes many cues: dealt by title before that, in as many tasks as the table's length asks for, and not again for its windows
    talk = talk.repartition(tasks(talk.count(), spark.sparkContext.defaultParallelism), "title_id")
    before = F.lag("role").over(Window.partitionBy("title_id").orderBy("turn"))
    talk = talk.withColumn("new_speaker", F.coalesce(before != F.col("role"), F.lit(False)))
    words = F.filter(F.split(F.regexp_replace("text", "[ \t\r\n]+", " "), " "), lambda w: w != "")
    talk = talk.withColumn("w", words).where(F.size("w") > 0)
    cut = talk.select(
        "title_id", "turn", "role", "new_speaker",
        F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(4)), lambda i: F.array_join(F.slice("w", i, 4), " "))).alias("chunk", "t"),
    )
    own = cut.withColumn("pos", F.row_number().over(Window.partitionBy("title_id").orderBy("turn", "chunk")).cast("bigint"))
    own = own.withColumn("marker", F.when(F.col("new_speaker") & (F.col("chunk") == 0), "[SC] ").when(F.col("pos") % 11 == 0, "[NM] ").otherwise(""))
    own = own.withColumn("dur", 250 + F.length("t") * (35 + (F.col("pos") * 13) % 50)).withColumn("gap", (F.col("pos") * 37) % 1500 - 60)
    own = own.withColumn("start_ms", F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(by_pos().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint"))
    return own.select("title_id", "pos", F.col("pos").cast("int").alias("idx"), "role", "marker", "t", "start_ms", (F.col("start_ms") + F.col("dur")).cast("bigint").alias("end_ms"))


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues with faults put in by position: (title_id, pos, idx, start_ms, end_ms, text)."""
    own = base_cues(spark, sf_dir)
    pos, t = F.col("pos"), F.col("t")
    w = F.split(t, " ")
    half = F.greatest(F.least(F.lit(2), F.size(w)), F.lit(1))
    front, back = F.array_join(F.slice(w, 1, half), " "), F.array_join(F.slice(w, 3, 4), " ")
    thrice = F.concat_ws(" ", t, t, t)
    text = (
        F.when(pos % 13 == 3, F.concat(t, F.lit("!")))
        .when(pos % 17 == 5, F.concat(t, F.lit(";")))
        .when(pos % 19 == 7, F.concat(t, F.lit("…")))
        .when(pos % 23 == 9, F.concat(t, F.lit("...")))
        .when(pos % 29 == 11, F.when(pos % 2 == 0, "").otherwise("  "))
        .when(pos % 31 == 13, F.concat(front, F.lit("\n"), back))
        .when(pos % 37 == 15, F.concat(F.lit("- "), front, F.lit("\n- "), back))
        .when(pos % 41 == 17, F.coalesce(F.lag("t").over(by_pos()), t))
        .when(pos % 43 == 19, F.concat(F.lit("..."), t))
        .when(pos % 47 == 21, thrice)
        .when(pos % 53 == 23, F.concat_ws("\n", t, t, t))
        .when(pos % 59 == 25, F.concat(thrice, F.lit("\n"), t))
        .when(pos % 61 == 27, F.concat(t, F.lit("\n"), F.element_at(w, 1)))
        .when(pos % 67 == 29, F.concat(t, F.lit(" "), t, F.lit("\n"), front))
        .when(pos % 71 == 31, F.concat(F.lit("-"), thrice))
        .when(pos % 73 == 33, F.concat(front, F.lit(" - "), back))
        .otherwise(t)
    )
    jump = F.when(pos % 97 == 50, 5).otherwise(0)
    return own.select("title_id", "pos", (F.col("idx") + jump).cast("int").alias("idx"), "start_ms", F.when(pos % 101 == 60, F.col("start_ms")).otherwise(F.col("end_ms")).alias("end_ms"), text.alias("text"))


def marked_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues with merge markers: (title_id, pos, idx, start_ms, end_ms, text)."""
    own = base_cues(spark, sf_dir)
    pos, t = F.col("pos"), F.col("t")
    text = F.when(pos % 9 == 4, F.concat(t, F.lit("..."))).when(pos % 9 == 5, F.concat(F.lit("..."), t)).when(pos % 37 == 15, F.concat(t, F.lit("\n-"), F.substring_index(t, " ", 1))).otherwise(t)
    return own.select("title_id", "pos", "idx", "start_ms", "end_ms", F.concat("marker", text).alias("text"))


def en_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_cues(spark, sf_dir).select("title_id", "pos", "idx", "start_ms", "end_ms", F.col("t").alias("text"))


def nl_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other version: every seventh cue is joined to the one before it, which has both texts and is shown for longer, starts move a little, a run of seven moves by six seconds, texts vary."""
    own, pos = base_cues(spark, sf_dir), F.col("pos")
    own = own.withColumn("t", F.concat_ws(" ", "t", F.when(pos % 7 == 6, F.lead("t").over(by_pos()))))
    t = F.col("t")
    w = F.split(t, " ")
    text = (
        F.when(pos % 9 == 4, F.array_join(F.slice(w, 1, 2), " "))
        .when(pos % 10 == 3, F.concat(t, F.lit(" als je het weet")))
        .when(pos % 12 == 5, F.concat(t, F.lit(" zegt u nu")))
        .when(pos % 15 == 6, F.concat(F.lit("Toen gaat hij "), t))
        .when(pos % 16 == 7, F.concat(t, F.lit("...")))
        .when(pos % 18 == 8, F.concat(t, F.lit("\n-"), F.element_at(w, 1)))
        .when(pos % 20 == 9, F.lit("een heel ander verhaal"))
        .otherwise(t)
    )
    late = F.when((pos >= 20) & (pos <= 26), 6000).otherwise(0)
    moved = (pos % 5) * 90 + late
    end = F.when(pos % 7 == 6, F.coalesce(F.lead("end_ms").over(by_pos()), F.col("end_ms"))).otherwise(F.col("end_ms"))
    own = own.select("title_id", "pos", (F.col("start_ms") + moved).alias("start_ms"), (end + moved).alias("end_ms"), text.alias("text")).where(pos % 7 != 0)
    return own.withColumn("pos", F.row_number().over(Window.partitionBy("title_id").orderBy("start_ms", "pos")).cast("bigint")).select("title_id", "pos", F.col("pos").cast("int").alias("idx"), "start_ms", "end_ms", "text")


def speech_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(title_id, frame_idx, is_speech) for every 30 ms, generated cue by cue."""
    own = base_cues(spark, sf_dir)
    pos = F.col("pos")
    following = F.coalesce(F.lead("start_ms").over(by_pos()), F.col("end_ms") + 900)
    lo, hi = F.floor(F.col("start_ms") / 30), F.floor(following / 30) - 1
    own = own.withColumn("from", F.col("start_ms") + (pos * 53) % 400).withColumn("to", F.col("end_ms") - (pos * 71) % 1200).withColumn("lo", lo).withColumn("hi", hi).where("hi >= lo")
    own = own.select("title_id", "from", "to", F.explode(F.sequence("lo", "hi")).alias("frame_idx"))
    at = F.col("frame_idx") * 30
    return own.select("title_id", "frame_idx", ((at >= F.col("from")) & (at < F.col("to")) & (F.col("frame_idx") % 40 >= 3)).alias("is_speech"))


#: The same as DuckDB common table expressions.
SQL = r"""
talk AS (
  SELECT conv_id, turn, role, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, false) AS new_speaker,
         list_filter(string_split(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM conversations
), cut AS (
  SELECT conv_id::VARCHAR AS title_id, turn, role, new_speaker, k, array_to_string(w[4 * k + 1:4 * k + 4], ' ') AS t
  FROM (SELECT *, unnest(range(0, (len(w) + 3) // 4)) AS k FROM talk WHERE len(w) > 0)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY title_id ORDER BY turn, k) AS pos FROM cut
), timed AS (
  SELECT title_id, pos, role, t, CASE WHEN new_speaker AND k = 0 THEN '[SC] ' WHEN pos % 11 = 0 THEN '[NM] ' ELSE '' END AS marker,
         250 + length(t) * (35 + (pos * 13) % 50) AS dur, (pos * 37) % 1500 - 60 AS gap FROM numbered
), base AS (
  SELECT title_id, pos, pos::INT AS idx, role, marker, t, string_split(t, ' ') AS w, s::BIGINT AS start_ms, (s + dur)::BIGINT AS end_ms
  FROM (SELECT *, coalesce(sum(dur + gap) OVER (PARTITION BY title_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM timed)
), en AS (
  SELECT title_id, pos, idx, start_ms, end_ms, t AS text FROM base
), cues AS (
  SELECT title_id, pos, (idx + CASE WHEN pos % 97 = 50 THEN 5 ELSE 0 END)::INT AS idx, start_ms, CASE WHEN pos % 101 = 60 THEN start_ms ELSE end_ms END AS end_ms,
    CASE WHEN pos % 13 = 3 THEN t || '!' WHEN pos % 17 = 5 THEN t || ';' WHEN pos % 19 = 7 THEN t || '…' WHEN pos % 23 = 9 THEN t || '...'
         WHEN pos % 29 = 11 THEN CASE WHEN pos % 2 = 0 THEN '' ELSE '  ' END
         WHEN pos % 31 = 13 THEN f || chr(10) || b WHEN pos % 37 = 15 THEN '- ' || f || chr(10) || '- ' || b
         WHEN pos % 41 = 17 THEN coalesce(before, t) WHEN pos % 43 = 19 THEN '...' || t WHEN pos % 47 = 21 THEN t || ' ' || t || ' ' || t
         WHEN pos % 53 = 23 THEN t || chr(10) || t || chr(10) || t WHEN pos % 59 = 25 THEN t || ' ' || t || ' ' || t || chr(10) || t
         WHEN pos % 61 = 27 THEN t || chr(10) || w[1] WHEN pos % 67 = 29 THEN t || ' ' || t || chr(10) || f WHEN pos % 71 = 31 THEN '-' || t || ' ' || t || ' ' || t
         WHEN pos % 73 = 33 THEN f || ' - ' || b ELSE t END AS text
  FROM (SELECT *, array_to_string(w[1:2], ' ') AS f, array_to_string(w[3:6], ' ') AS b, lag(t) OVER (PARTITION BY title_id ORDER BY pos) AS before FROM base)
), marked AS (
  SELECT title_id, pos, idx, start_ms, end_ms, marker || CASE WHEN pos % 9 = 4 THEN t || '...' WHEN pos % 9 = 5 THEN '...' || t WHEN pos % 37 = 15 THEN t || chr(10) || '-' || w[1] ELSE t END AS text FROM base
), shifted AS (
  SELECT title_id, pos, start_ms + m AS start_ms, e + m AS end_ms, text FROM (
    SELECT title_id, pos, start_ms, (pos % 5) * 90 + CASE WHEN pos BETWEEN 20 AND 26 THEN 6000 ELSE 0 END AS m,
      CASE WHEN pos % 7 = 6 THEN coalesce(lead(end_ms) OVER (PARTITION BY title_id ORDER BY pos), end_ms) ELSE end_ms END AS e,
      CASE WHEN pos % 9 = 4 THEN array_to_string(w[1:2], ' ') WHEN pos % 10 = 3 THEN t || ' als je het weet' WHEN pos % 12 = 5 THEN t || ' zegt u nu' WHEN pos % 15 = 6 THEN 'Toen gaat hij ' || t
           WHEN pos % 16 = 7 THEN t || '...' WHEN pos % 18 = 8 THEN t || chr(10) || '-' || w[1] WHEN pos % 20 = 9 THEN 'een heel ander verhaal' ELSE t END AS text
    FROM (SELECT * REPLACE (string_split(t, ' ') AS w) FROM (SELECT * REPLACE (concat_ws(' ', t, CASE WHEN pos % 7 = 6 THEN lead(t) OVER (PARTITION BY title_id ORDER BY pos) END) AS t) FROM base))) WHERE pos % 7 <> 0
), nl AS (
  SELECT title_id, row_number() OVER (PARTITION BY title_id ORDER BY start_ms, pos) AS pos, (row_number() OVER (PARTITION BY title_id ORDER BY start_ms, pos))::INT AS idx, start_ms, end_ms, text FROM shifted
), frames AS (
  SELECT title_id, frame_idx, frame_idx * 30 >= a AND frame_idx * 30 < b AND frame_idx % 40 >= 3 AS is_speech
  FROM (SELECT title_id, a, b, unnest(range(lo, hi)) AS frame_idx FROM (
    SELECT title_id, start_ms + (pos * 53) % 400 AS a, end_ms - (pos * 71) % 1200 AS b, start_ms // 30 AS lo, coalesce(lead(start_ms) OVER (PARTITION BY title_id ORDER BY pos), end_ms + 900) // 30 AS hi FROM base))
)
"""
