"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Of all rates r of documents, between 0 and CAP, with sum(size * r) = target over each
source, the entropy-balanced ones have the least relative entropy to taking every
document once. They are exponentially tilted, r = min(CAP, exp(l * size / m)), with one
multiplier l for each source, the maximiser of the convex dual

    target * l - sum(phi(l * size / m)),   phi' = size-weighted min(CAP, exp).

m, the largest size of the source, only sets the scale of l. Newton iterations solve
the dual's condition sum(size * r) = target, in logarithms: each step is one
aggregation of the taken words and their derivative over all documents, by way of a
histogram of (source, size) that is counted once. A step that leaves the interval in
which the solution is known to lie is replaced by its middle. Sums are of exact
decimals, so that they don't depend on the order of rows. Iterations go on until every
source is near its target, and STEPS more.

Rates become copies. Documents of a source go in the order of size; a document gets
floor(r) copies, and one more wherever the running sum of the fractions passes an
integer, so that its source's words differ from the target by one document at most,
however many there are. A document that holds over 1 / HEAVY of its source's target is
too coarse for that: it gets its share of words, the last copy being cut at a word; what
rounding to words leaves is carried to the next one.

A hot source is split: prefix sums run inside cells of (source, size, SALTS), then over
the cells of a size class, then over the classes of a source. Cells follow the order of
the documents, so they change no result. Equal rows are counted as one with a number.

Null texts have size 0. A null source is a source, last in order. Rows are taken as they
are, repeated ones too; of equal sizes those with the smaller MD5 of doc_id as text come
first, null ids before them. Without words every target is 0 and nothing is taken. Other
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.llm.store import stored

#: Weights of the sources in order, repeating; a target is at most CAP times its source's size.
WEIGHTS, CAP = (1, 2, 3), 3
#: Rates are rounded to this fraction, so that sums are exact.
UNIT = 1_000_000
#: How near the logarithm of the taken words must be to that of the target, steps after that, steps between two looks, and the most steps.
NEAR, STEPS, MOST_STEPS = 1e-5, 3, 120
#: A document with more than this fraction of its source's target is cut rather than rounded.
HEAVY = 100

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes, which has one row (source, source_size, ..) for each source, with its target.

    Shares are filled like vessels: sources in the order in which they reach their
    caps, the level is what is left over the weights left, until a level is below
    the cap of the next.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("_ratio"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    own = sizes.withColumn("_w", weight.cast("long")).withColumn("_cap", cap * F.col("source_size"))
    own = own.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    own = own.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    own = own.withColumn("_weights", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    own = own.withColumn("_open", F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weights"))
    own = own.withColumn("_level", F.min(F.when(F.col("_open"), F.struct("_ratio", F.col("source").isNull().alias("n"), "source", "_left", "_weights"))).over(everything))
    filled = F.col("_level._left") * F.col("_w") / F.col("_level._weights")
    reached = F.col("_level").isNull() | (F.col("_left") * F.col("_w") > F.col("_cap") * F.col("_weights"))
    return own.select(*sizes.columns, F.when(reached, F.col("_cap").cast("double")).otherwise(filled).alias("target"))


def tilt(at: Column, size: Column, largest: Column, cap: int = CAP) -> Column:
    """A document's rate under its source's multiplier."""
    return F.least(F.lit(float(cap)), F.exp(at * size / largest))


def multipliers(sizes: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """(_src, l) for sources (_src, source_size, target, least, largest) whose targets lie between 0 and their caps; sizes has (_src, size, n)."""
    goal = F.log(F.col("target") / F.col("source_size"))
    # all documents at the rate of the smallest bound the multiplier from the other side
    far = F.when(goal < 0, goal).otherwise(F.lit(math.log(cap))) * F.col("largest") / F.col("least")
    open_ones = sources.where((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size")))
    now = open_ones.select("_src", "target", "largest", F.least(far, F.lit(0.0)).alias("lo"), F.greatest(far, F.lit(0.0)).alias("hi"), F.lit(0.0).alias("l"), F.lit(1.0).alias("miss"))
    known = sizes.where("size > 0")
    after = 0
    for _ in range(0, MOST_STEPS, STEPS):
        for _ in range(STEPS):
            now = _newton(known, now, cap)
        now = stored(now)
        if after or (now.agg(F.max("miss")).first()[0] or 0.0) < NEAR:
            after += 1
        if after == 2:
            break
    if not after:
        raise RuntimeError("rates of a source did not settle")
    return now.select("_src", "l")


def _newton(sizes: DataFrame, now: DataFrame, cap: int) -> DataFrame:
    """One step: the words that are taken under the multipliers, their derivatives, and better multipliers."""
    rate = tilt(F.col("l"), F.col("size"), F.col("largest"), cap)
    words = F.col("n") * F.col("size") * rate
    rising = F.when(rate < cap, words * F.col("size") / F.col("largest")).otherwise(0.0)
    exact = [F.sum(x.cast("decimal(38,12)")).cast("double").alias(name) for x, name in ((words, "_g"), (rising, "_h"))]
    keys = ["_src", "target", "largest", "lo", "hi", "l"]
    at = sizes.join(now.drop("miss"), "_src").groupBy(*keys).agg(*exact)
    miss = F.log(F.col("target") / F.col("_g"))
    lo, hi = F.when(miss > 0, F.col("l")).otherwise(F.col("lo")), F.when(miss < 0, F.col("l")).otherwise(F.col("hi"))
    at = at.select("_src", "target", "largest", lo.alias("lo"), hi.alias("hi"), "l", miss.alias("miss"), (F.col("l") + miss * F.col("_g") / F.col("_h")).alias("_next"))
    inside = (F.col("_next") >= F.col("lo")) & (F.col("_next") <= F.col("hi"))
    chosen = F.when(F.col("miss") == 0, F.col("l")).when(inside, F.col("_next")).otherwise((F.col("lo") + F.col("hi")) / 2)
    return at.select("_src", "target", "largest", "lo", "hi", chosen.alias("l"), F.abs("miss").alias("miss"))


def _rows(docs: DataFrame) -> DataFrame:
    """Distinct rows (_src, source, doc_id, size, _tie) with their number n."""
    rows = docs.select("doc_id", "source", _named().alias("_src"), n_words().alias("size"), F.xxhash64("doc_id", "text").alias("_tie"))
    mark = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    return stored(rows.groupBy("_src", "source", "doc_id", "size", "_tie").agg(F.count("*").alias("n")).withColumn("_mark", mark).withColumn("_salt", F.substring("_mark", 1, 2)))


def _named() -> Column:
    """A name for each source that is not null."""
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))


def _balanced(rows: DataFrame, weights: tuple[int, ...], cap: int, heavy: int = HEAVY) -> DataFrame:
    """Distinct rows (_src, doc_id, size, _tie) with their number n, what their source has, their rate in units of 1 / UNIT, what is rounded of them (_part) and the running sum of that up to the last of them (_upto)."""
    cells = stored(rows.groupBy("_src", "source", "size", "_salt").agg(F.sum("n").alias("_n")))
    sizes = stored(cells.groupBy("_src", "source", "size").agg(F.sum("_n").alias("n")))
    sums = sizes.groupBy("_src", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"), F.max("size").alias("largest"))
    sources = stored(targets(sums, weights, cap))
    solved = sources.join(multipliers(sizes, sources, cap), "_src", "left").drop("source")
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= cap * F.col("source_size"), float(cap)).otherwise(tilt(F.col("l"), F.col("size"), F.col("largest"), cap))
    # by size class, too, so that the cells of a hot source are spread
    solved = solved.withColumn("_class", F.explode(F.sequence(F.lit(1), F.lit(64))))
    cells = cells.drop("source").withColumn("_class", F.length(F.bin("size"))).join(solved, ["_src", "_class"])
    cells = cells.withColumn("rate", F.when(F.col("size") > 0, F.round(rate * UNIT)).otherwise(0).cast("long")).withColumn("_heavy", F.col("size") * heavy > F.col("target"))
    cells = cells.withColumn("_part", F.when(F.col("_heavy"), F.col("size") * F.col("rate") % UNIT).otherwise(F.col("rate") % UNIT)).withColumn("_sum", F.col("_n") * F.col("_part"))
    earlier = Window.partitionBy("_src", "_heavy", "_class").orderBy("size", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    classes = cells.groupBy("_src", "_heavy", "_class").agg(F.sum("_sum").alias("_sum"))
    lighter = Window.partitionBy("_src", "_heavy").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("_src", "_heavy", "_class", F.coalesce(F.sum("_sum").over(lighter), F.lit(0)).alias("_first"))
    cells = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).join(classes, ["_src", "_heavy", "_class"])
    own = rows.join(cells.select("_src", "size", "_salt", "source_size", "target", "rate", "_heavy", "_part", (F.col("_first") + F.col("_before")).alias("_before")), ["_src", "size", "_salt"])
    inside = Window.partitionBy("_src", "size", "_salt").orderBy("_mark", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumn("_upto", F.col("_before") + F.sum(F.col("n") * F.col("_part")).over(inside))


def _words(times: str, upto: str, part: str) -> Column:
    """The words that so many equal rows take, of which the last brings the running sum to `upto`."""
    half = UNIT // 2
    more = f"(({upto} + {half}) div {UNIT} - ({upto} - {times} * {part} + {half}) div {UNIT})"
    return F.when(F.col("_heavy"), F.expr(f"{times} * (size * rate div {UNIT}) + {more}")).otherwise(F.expr(f"size * ({times} * (rate div {UNIT}) + {more})")).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, taken) for each row of docs; rate in units of 1 / UNIT."""
    own = _balanced(_rows(docs), weights, cap, heavy).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    taken = _words("1", "(_upto - (n - _k) * _part)", "_part")
    return own.select("doc_id", "source", "size", "source_size", "target", "rate", taken.alias("taken"))


def copies(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that the mix takes, as often as it takes them; a last copy that is cut ends at a word. A document without words is not taken. Rows with equal doc_id, source and text are one document that is repeated, with the other columns of the one that sorts first."""
    rows = _rows(docs)
    mixed = _balanced(rows, WEIGHTS, CAP).withColumn("taken", _words("n", "_upto", "_part")).where("taken > 0")
    mixed = mixed.select(F.col("doc_id").alias("_id"), F.col("_src").alias("_name"), "_tie", "size", "n", "taken")
    own = docs.select(*columns).withColumn("_h", F.xxhash64("doc_id", "text")).withColumn("_src", _named())
    met = own.join(mixed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_tie")) & (F.col("_src") == F.col("_name")))
    many = met.select(*columns, "size", "taken")
    if rows.where("n > 1").limit(1).count():
        many = met.where("n = 1").select(*columns, "size", "taken").union(_once(met, columns))
    many = many.withColumn("_copy", F.explode(F.expr("sequence(1, cast((taken + size - 1) div size as int))")))
    rest = F.col("taken") - (F.col("_copy") - 1) * F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), rest.cast("int")), " ")
    made = many.withColumn("text", F.when(rest < F.col("size"), cut).otherwise(F.col("text")))
    if "n_chars" in columns:
        made = made.withColumn("n_chars", F.length("text").cast("long"))
    return made.select(*columns)


def _once(met: DataFrame, columns: list[str]) -> DataFrame:
    """One row for all that repeat each other, with what they take together."""
    return met.where("n > 1").groupBy("_id", "_name", "_h").agg(F.min(F.struct(*columns)).alias("_row"), F.first("size").alias("size"), F.first("taken").alias("taken")).select("_row.*", "size", "taken")


#: The same in DuckDB SQL: Newton steps in a recursive query over each source's histogram. Expects distinct doc_id.
ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, min(size) FILTER (WHERE size > 0) AS least_size, max(size) AS largest FROM sized GROUP BY source
), weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap,
         (3 * source_size)::DOUBLE / ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS ratio FROM sources
), ranked AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT AS rest, (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS ws
  FROM weighted WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, ws FROM ranked WHERE rest * w <= cap * ws ORDER BY ratio, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, least_size, largest, CASE WHEN r.rest * w > cap * r.ws THEN cap::DOUBLE ELSE (l.rest * w)::DOUBLE / l.ws END AS target FROM ranked r, level l
), hist AS (
  SELECT source, list({'s': size::DOUBLE, 'n': n::DOUBLE} ORDER BY size) AS h FROM (SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY 1, 2) GROUP BY 1
), start AS (
  SELECT t.source, target, largest::DOUBLE AS m, h, CASE WHEN target < source_size THEN ln(target / source_size) ELSE ln(3) END * largest / least_size AS far
  FROM targets t JOIN hist ON t.source IS NOT DISTINCT FROM hist.source WHERE target > 0 AND target < 3 * source_size
), steps AS (
  SELECT 0 AS k, source, target, m, h, least(far, 0) AS lo, greatest(far, 0) AS hi, 0::DOUBLE AS l FROM start
  UNION ALL
  SELECT k + 1, source, target, m, h, nlo, nhi, CASE WHEN miss = 0 THEN l WHEN nxt >= nlo AND nxt <= nhi THEN nxt ELSE (nlo + nhi) / 2 END
  FROM (SELECT *, l + miss * g / d AS nxt, CASE WHEN miss > 0 THEN l ELSE lo END AS nlo, CASE WHEN miss < 0 THEN l ELSE hi END AS nhi
        FROM (SELECT *, ln(target / g) AS miss
              FROM (SELECT *, list_sum(list_transform(h, lambda x: x.n * x.s * least(3.0::DOUBLE, exp(l * x.s / m)))) AS g,
                           list_sum(list_transform(h, lambda x: CASE WHEN exp(l * x.s / m) < 3 THEN x.n * x.s * exp(l * x.s / m) * x.s / m ELSE 0 END)) AS d FROM steps WHERE k < 60)))
), solved AS (
  SELECT source, l FROM steps WHERE k = 60
), rated AS (
  SELECT d.*, t.source_size, t.target, d.size * 100 > t.target AS heavy,
         CASE WHEN d.size = 0 OR t.target <= 0 THEN 0 WHEN t.target >= 3 * t.source_size THEN 3000000 ELSE round(least(3.0::DOUBLE, exp(s.l * d.size / t.largest)) * 1000000)::BIGINT END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN solved s ON d.source IS NOT DISTINCT FROM s.source
), parts AS (
  SELECT *, CASE WHEN heavy THEN size * rate % 1000000 ELSE rate % 1000000 END AS part FROM rated
), run AS (
  SELECT *, sum(part) OVER (PARTITION BY source, heavy ORDER BY size, md5(doc_id::VARCHAR)) AS upto FROM parts
), more AS (
  SELECT *, (upto + 500000) // 1000000 - (upto - part + 500000) // 1000000 AS more FROM run
)
SELECT doc_id, size, source_size, target, (CASE WHEN heavy THEN size * rate // 1000000 + more ELSE size * (rate // 1000000 + more) END)::BIGINT AS taken FROM more
"""
