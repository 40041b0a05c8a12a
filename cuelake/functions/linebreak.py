"""Where a two-line cue should break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelake.functions import text as T

# Words that bind to the next one.
BIND_FORWARD = (
    "de", "het", "een", "deze", "die", "dit", "dat", "mijn", "jouw", "zijn", "haar", "ons", "onze", "hun", "z'n", "d'r", "m'n", "niet", "geen", "noch", "nooit",
    "zich", "alle", "elk", "elke", "iedere", "veel", "weinig", "enkele", "sommige", "meer", "meeste", "vele",
)

# Words before which a break is good.
BREAK_BEFORE = (
    "en", "of", "maar", "want", "dus", "noch", "dat", "die", "wie", "wat", "waar", "omdat", "hoewel", "terwijl", "als", "toen", "nadat", "voordat", "zodra", "tenzij",
    "mits", "wanneer", "waardoor", "waarmee", "waarin", "waarop", "waarbij", "zodat", "doordat", "aangezien", "ofschoon", "alhoewel", "totdat", "in", "op", "aan",
    "bij", "met", "van", "voor", "naar", "over", "door", "uit", "onder", "tussen", "tegen", "tot", "om", "zonder", "achter", "langs", "binnen", "buiten", "boven",
    "beneden", "tijdens", "sinds", "vanaf", "wegens", "ondanks", "behalve", "volgens", "naast", "rondom", "waarvan", "waarvoor", "waaruit", "waarover",
)

# Names that stay on one line.
KEEP_TOGETHER = (
    "New Deal", "Sovjet-Unie", "Eerste Wereldoorlog", "Tweede Wereldoorlog", "Mein Kampf", "Rode Kruis", "Rode Leger", "Derde Rijk", "Heilige Stoel",
    "Verenigde Staten", "Verenigd Koninkrijk", "Europese Unie", "Verenigde Naties",
)

ORPHAN_WORDS, ORPHAN_CHARS = 2, 8
# Marks that a word may end with.
_TAIL = ".,;:!?…"


def with_best_break(df: DataFrame, text: str, to: str, width: int = 42) -> DataFrame:
    """df with a column `to`. Words, and both sides of every boundary with their lengths, are made column by column, so that none of it is worked out again for each use."""
    own = T.once(df, _w=T.words(F.col(text)), _low=F.lower(text))
    # the few names that a text has: only those are looked for on both sides of its boundaries
    own = T.once(own, _n=F.size("_w"), _names=F.filter(F.array(*(F.lit(p.lower()) for p in KEEP_TOGETHER)), lambda p: F.contains(F.col("_low"), p)))

    def sides(k: Column) -> Column:
        top, bottom = F.array_join(F.slice("_w", F.lit(1), k), " "), F.array_join(F.slice("_w", k + 1, F.col("_n") - k), " ")
        return F.struct(k.alias("k"), top.alias("top"), bottom.alias("bottom"), F.element_at("_w", k).alias("before"), F.element_at("_w", k + 1).alias("after"))

    boundaries = F.when((F.length(text) > width) & (F.col("_n") >= 2), F.transform(F.sequence(F.lit(1), F.greatest(F.col("_n") - 1, F.lit(1))), sides)).otherwise(F.array())
    own = T.once(own, _o=F.filter(boundaries, lambda o: (F.length(o["top"]) <= width) & (F.length(o["bottom"]) <= width)))
    own = T.once(own, _o=F.array_max(F.transform("_o", lambda o: _scored(o, F.col("_n"), F.col("_names")))))
    best = F.when(F.col("_o.score") >= -5, F.struct(F.col("_o.top").alias("top"), F.col("_o.bottom").alias("bottom")))
    return T.once(own, **{to: best}).drop("_w", "_n", "_low", "_names", "_o")


def _scored(o: Column, n: Column, names: Column) -> Column:
    """struct(score, near, early, top, bottom): the greatest is the best boundary."""
    top, bottom, k = o["top"], o["bottom"], o["k"]
    a, b = F.length(top), F.length(bottom)
    # ratios as products, so that they are exact
    score = F.when((10 * a >= 6 * b) & (10 * a <= 9 * b), 3).when((10 * a > 9 * b) & (10 * a <= 11 * b), 2).when((10 * a >= 4 * b) & (10 * a < 6 * b), 1).when(10 * a > 11 * b, -1).otherwise(0)
    score = score + F.when(2 * a > 3 * b, -3).otherwise(0)
    score = score + F.when((k == 1) & (a < ORPHAN_CHARS), -5).otherwise(0) + F.when((k == n - 1) & (b < ORPHAN_CHARS), -5).otherwise(0)
    score = score + F.when(F.rtrim(o["before"], F.lit(".,;:!?")) != o["before"], 4).otherwise(0)
    score = score + F.when(F.lower(F.rtrim(F.ltrim(o["after"], F.lit("-")), F.lit(_TAIL))).isin(*BREAK_BEFORE), 2).otherwise(0)
    score = score + F.when(F.lower(F.rtrim(o["before"], F.lit(_TAIL))).isin(*BIND_FORWARD), -10).otherwise(0)
    kept = F.filter(names, lambda p: ~F.contains(F.lower(top), p) & ~F.contains(F.lower(bottom), p))
    score = score - 10 * F.size(kept)
    return F.struct(score.alias("score"), (-F.abs(a - b)).alias("near"), (-k).alias("early"), top.alias("top"), bottom.alias("bottom"))


def balance_issues(text: Column, ratio: float = 1.5) -> Column:
    """array<struct<type, severity>> for a two-line cue of one speaker, else empty."""
    parts = T.lines(text)

    def issue(kind: str, severity: Column) -> Column:
        return F.when(severity.isNotNull(), F.struct(F.lit(kind).alias("type"), severity.alias("severity")))

    def orphan(n: Column, own: Column, other: Column) -> Column:
        return F.when((n == 1) & (own < ORPHAN_CHARS), "high").when((n <= ORPHAN_WORDS) & (own < ORPHAN_CHARS) & (other > 25), "medium")

    def measured(s: Column) -> Column:
        return F.struct(F.length(s["top"]).alias("a"), F.length(s["bottom"]).alias("b"), T.words(s["top"]).alias("w"), F.size(T.words(s["bottom"])).alias("bw"))

    def found(m: Column) -> Column:
        a, b, tw = m["a"], m["b"], F.size(m["w"])
        heavy = F.when((a > 0) & (b > 0) & (a > ratio * b) & (a - b > 10), F.when(a > 2 * b, "high").otherwise("medium"))
        last = F.lower(F.rtrim(F.try_element_at(m["w"], F.lit(-1)), F.lit(_TAIL)))
        bad = F.when((tw > 0) & last.isin(*BIND_FORWARD), "high")
        return F.filter(F.array(issue("orphan_top", orphan(tw, a, b)), issue("orphan_bottom", orphan(m["bw"], b, a)), issue("top_heavy", heavy), issue("bad_break", bad)), lambda x: x.isNotNull())

    # lines, then their lengths and words, are each worked out once
    ends = F.struct(T.rstrip(F.try_element_at(parts, F.lit(1))).alias("top"), T.rstrip(F.try_element_at(parts, F.lit(2))).alias("bottom"))
    none = F.array().cast("array<struct<type: string, severity: string>>")
    return F.when((F.size(parts) == 2) & ~T.is_dual_speaker(text), T.bound(T.bound(ends, measured), found)).otherwise(none)
