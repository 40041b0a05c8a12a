"""Text and time functions on columns. Lengths count code points; white space is Unicode's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Replies that carry nothing as a cue of their own.
TRIVIAL_REPLIES = (
    "ja", "nee", "oké", "goed", "sorry", "pardon", "dank je", "dank u", "bedankt", "precies",
    "inderdaad", "natuurlijk", "absoluut", "zeker", "juist", "klopt", "prima", "top", "mooi", "fijn",
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def collapse(c: Column) -> Column:
    """Single spaces between words, none around them."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(c, r"(?U)\s+", " "), " "), lambda w: w != "")


def visible_length(c: Column) -> Column:
    """Length with each '...' as one."""
    return F.length(c) - 2 * F.regexp_count(c, F.lit(r"\.\.\."))


def char_count(text: Column) -> Column:
    return visible_length(F.replace(text, F.lit("\n"), F.lit("")))


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def cps(text: Column, duration_ms: Column) -> Column:
    """Characters a second; null without a positive duration."""
    return F.when(duration_ms > 0, char_count(text) / (duration_ms / F.lit(1000.0)))


def micro_cps(text: Column, duration_ms: Column) -> Column:
    """The same in whole millionths."""
    return F.when(duration_ms > 0, F.floor(char_count(text) * F.lit(1000000000).cast("bigint") / F.lit(1) / duration_ms)).cast("bigint")


def is_dual_speaker(text: Column) -> Column:
    """A second line that starts with a dash, or one line with a dash between spaces."""
    parts = lines(text)
    return F.when(F.size(parts) >= 2, lstrip(F.try_element_at(parts, F.lit(2))).startswith("-")).otherwise(text.rlike(r"(?U)\s+-\s+"))


def timecode_to_ms(code: Column) -> Column:
    """Milliseconds of H:MM:SS,mmm or H:MM:SS.mmm; null otherwise."""
    pattern = r"^(\d{1,2}):(\d{2}):(\d{2})[,.](\d{3})$"

    def part(k: int) -> Column:
        return F.regexp_extract(strip(code), pattern, k).try_cast("bigint")

    return ((part(1) * 60 + part(2)) * 60 + part(3)) * 1000 + part(4)


def ms_to_timecode(ms: Column) -> Column:
    at = F.greatest(ms, F.lit(0).cast("bigint"))
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(at / 3600000), F.floor(at / 60000) % 60, F.floor(at / 1000) % 60, at % 1000)


def clock(ms: Column) -> Column:
    """H:MM:SS."""
    return F.format_string("%d:%02d:%02d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60)


def classify_fps(fps: Column) -> Column:
    """24 or 25, from a number or a fraction in text."""
    text = fps.cast("string")
    value = F.when(text.contains("/"), F.try_divide(F.substring_index(text, "/", 1).try_cast("double"), F.substring_index(text, "/", -1).try_cast("double"))).otherwise(text.try_cast("double"))
    return F.when(value < 24.5, 24).when(value.isNotNull(), 25)


def fix_punctuation(text: Column) -> Column:
    return F.translate(text, "!;", "..")


def fix_ellipsis(text: Column) -> Column:
    return F.replace(text, F.lit("…"), F.lit("..."))


def continuation(text: Column) -> Column:
    """A comma at the end of a cue becomes an ellipsis."""
    return F.regexp_replace(text, r",$", "...")


def fix_speaker_dash(text: Column) -> Column:
    """Of two dashed lines only the second keeps its dash, without a space after it."""
    parts = lines(text)
    one, two = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    dashed = strip(two).startswith("-")

    def bare(c: Column) -> Column:
        return lstrip(F.regexp_replace(c, "^-+", ""))

    first = F.when(one.startswith("-") & dashed, bare(one)).otherwise(one)
    second = F.when(dashed, F.concat(F.lit("-"), bare(two))).otherwise(two)
    return F.when(F.size(parts) == 2, F.concat(first, F.lit("\n"), second)).otherwise(text)


def undashed(line: Column) -> Column:
    return F.regexp_replace(line, r"(?U)^-\s?", "")


def greedy_lines(parts: Column, width: int) -> Column:
    """Words filled into lines of at most `width` characters, joined by line breaks."""

    def put(done: Column, word: Column) -> Column:
        room = F.length(F.substring_index(done, "\n", -1)) + 1 + F.length(word) <= width
        return F.when(done == "", word).when(room, F.concat(done, F.lit(" "), word)).otherwise(F.concat(done, F.lit("\n"), word))

    return F.aggregate(parts, F.lit(""), put)


def wrap_text(text: Column, width: int = 42, most: int = 2) -> Column:
    """Text filled into at most `most` lines, or null if it doesn't fit."""
    parts = words(text)
    filled = greedy_lines(parts, width)
    fits = F.forall(parts, lambda w: F.length(w) <= width) & (F.size(F.split(filled, "\n")) <= most)
    return F.when(fits, filled)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once: they are generated, and neither filters nor expressions after it are pushed through a generator."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*(made.alias(name) for name, made in columns.items())))))


def fix_line_length(text: Column, width: int = 42) -> Column:
    """A single line that is too long is broken: as many words on the first line as fit, then words move down until the first is not the longer one."""
    dashed = text.startswith("-")
    body = F.when(dashed, F.regexp_replace(text.substr(F.lit(2), F.length(text)), "^ +", "")).otherwise(text)
    prefix = F.when(dashed, F.lit("-")).otherwise(F.lit(""))

    def front(s: Column, k: Column) -> Column:
        return F.array_join(F.slice(s["parts"], F.lit(1), k), " ")

    def back(s: Column, k: Column) -> Column:
        return F.array_join(F.slice(s["parts"], k + 1, F.size(s["parts"])), " ")

    def greedy(s: Column) -> Column:
        return F.struct(s["parts"].alias("parts"), s["ends"].alias("ends"), F.size(F.filter(s["ends"], lambda e: e <= width)).alias("k"))

    def split(s: Column) -> Column:
        total = F.element_at(s["ends"], -1)
        # the words before and after are as long as the ends say: the first k, and the rest without the space between
        even = F.filter(F.sequence(F.lit(1), F.greatest(s["k"], F.lit(1))), lambda k: (k <= s["k"]) & (F.element_at(s["ends"], k) <= F.when(k < F.size(s["ends"]), total - F.element_at(s["ends"], k) - 1).otherwise(0)))
        heavy = (s["k"] < F.size(s["parts"])) & (back(s, s["k"]) != "") & (visible_length(front(s, s["k"])) > visible_length(back(s, s["k"])))
        k = F.when(heavy, F.coalesce(F.array_max(even), F.lit(0))).otherwise(s["k"])
        return bound(k, lambda at: F.struct(F.concat(prefix, front(s, at)).alias("one"), back(s, at).alias("two")))

    def joined(x: Column) -> Column:
        return F.array_join(F.filter(F.array(F.when((strip(x["one"]) != "") & (x["one"] != prefix), x["one"]), F.when(strip(x["two"]) != "", x["two"])), lambda y: y.isNotNull()), "\n")

    parts = F.split(body, " ")
    ends = F.aggregate(parts, F.array().cast("array<int>"), lambda a, w: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)) + 1, F.lit(0)) + F.length(w))))
    broken = bound(bound(bound(F.struct(parts.alias("parts"), ends.alias("ends")), greedy), split), joined)
    long = visible_length(undashed(text)) > width
    return F.when(~text.contains("\n") & long & (visible_length(body) > width), broken).otherwise(text)


def marker(text: Column) -> Column:
    """'SC' (speaker change), 'NM' (no merge) or ''."""
    return F.regexp_extract(text, r"(?U)^\s*\[(SC|NM)\]", 1)


def unmarked(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s*\[(SC|NM)\]\s*", "")


def is_trivial_reply(text: Column) -> Column:
    return F.lower(strip(F.regexp_replace(strip(text), r"[.?]+$", ""))).isin(*TRIVIAL_REPLIES)


def register(text: Column) -> Column:
    """'formal', 'informal', 'mixed' or null, by Dutch forms of address."""
    low = F.lower(text)

    def any_of(*parts: str) -> Column:
        found = F.lit(False)
        for p in parts:
            found = found | low.contains(p)
        return found

    you = any_of(" je ", " jij ", " jouw ")
    return F.when(any_of(" u ", " uw ", "mylord", "meneer", "mevrouw"), F.when(you, "mixed").otherwise("formal")).when(you | any_of(" m'n ", " z'n "), "informal")


def is_idiom_candidate(en: Column, nl: Column) -> Column:
    """At least three words each, at most one in common, and of similar length."""
    a, b = F.array_distinct(words(F.lower(en))), F.array_distinct(words(F.lower(nl)))

    def apart(w: Column) -> Column:
        common = F.filter(F.array_intersect(w["a"], w["b"]), lambda x: ~x.rlike(r"^\d+$"))
        return (F.size(w["a"]) >= 3) & (F.size(w["b"]) >= 3) & (F.size(common) <= 1)

    return (F.abs(F.length(en) - F.length(nl)) * 2 < F.length(en)) & bound(F.struct(a.alias("a"), b.alias("b")), apart)


# A fronted adverb, a verb and its subject.
INVERSION = r"\b(Toen|Nu|Daar|Hier|Daarom|Dus|Zo|Toch|Echter|Bovendien|Daarna|Gisteren|Vandaag)\s+\w+\s+(ik|hij|zij|wij|ze|we|je|u)\b"


def has_inversion(text: Column) -> Column:
    return text.rlike("(?U)" + INVERSION)


def imdb_id(name: Column) -> Column:
    return F.regexp_extract(name, r"(?i)imdb-tt(\d+)", 1)


def source_name(name: Column) -> Column:
    """A file's title: up to the first dot, and to the first bracketed tag."""
    out = F.substring_index(name, ".", 1)
    for tag in (" [imdb-", " [Bluray-", " [HDTV-"):
        out = F.substring_index(out, tag, 1)
    return out


def output_name(path: Column) -> Column:
    return F.regexp_replace(path, r"(\.en)?\.srt$", ".nl.srt")
