"""Words as they are spoken: numbers and contractions, for alignment with a recogniser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuelake.functions.text import strip

# English number words.
UNITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
ORDINALS = {"1st": "first", "2nd": "second", "3rd": "third", "4th": "fourth", "5th": "fifth", "6th": "sixth", "7th": "seventh", "8th": "eighth", "9th": "ninth", "10th": "tenth"}

# English contractions.
CONTRACTIONS = {
    "won't": "will not", "can't": "cannot", "couldn't": "could not", "wouldn't": "would not", "shouldn't": "should not", "don't": "do not", "doesn't": "does not",
    "didn't": "did not", "isn't": "is not", "aren't": "are not", "wasn't": "was not", "weren't": "were not", "hasn't": "has not", "haven't": "have not",
    "hadn't": "had not", "i'm": "i am", "i've": "i have", "i'll": "i will", "i'd": "i would", "you're": "you are", "you've": "you have", "you'll": "you will",
    "you'd": "you would", "he's": "he is", "she's": "she is", "it's": "it is", "we're": "we are", "we've": "we have", "we'll": "we will", "they're": "they are",
    "they've": "they have", "they'll": "they will", "there's": "there is", "that's": "that is", "what's": "what is", "who's": "who is", "let's": "let us",
}


def _pick(names: tuple[str, ...], k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), k.cast("int") + 1)


def _below_hundred(n: Column) -> Column:
    tens = _pick(TENS, F.greatest(F.floor(n / 10) - 2, F.lit(0)))
    return F.when(n < 20, _pick(UNITS, F.least(n, F.lit(19)))).when(n % 10 == 0, tens).otherwise(F.concat(tens, F.lit(" "), _pick(UNITS, n % 10)))


def number_to_words(text: Column) -> Column:
    """Numbers up to 1000, years 1900 to 2099 and ordinals to 10th; other digits one by one."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    n = F.least(F.greatest(F.coalesce(plain.try_cast("bigint"), F.lit(0)), F.lit(0)), F.lit(9999))
    canonical = plain == n.cast("string")
    low = n % 100
    rest = F.when(n % 100 == 0, "").otherwise(F.concat(F.lit(" and "), _below_hundred(low)))
    hundreds = F.concat(_pick(UNITS, F.least(F.floor(n / 100), F.lit(19))), F.lit(" hundred"))
    century = _below_hundred(F.floor(n / 100))
    year = (
        F.when(n == 2000, "two thousand")
        .when((n > 2000) & (n <= 2009), F.concat(F.lit("two thousand and "), _pick(UNITS, n % 10)))
        .when(low == 0, F.concat(century, F.lit(" hundred")))
        .otherwise(F.concat(century, F.lit(" "), _below_hundred(low)))
    )
    digits = F.array_join(F.transform(F.filter(F.split(plain, ""), lambda d: d.rlike("^[0-9]$")), lambda d: _pick(UNITS, d.cast("int"))), " ")
    out = F.when(canonical & (n <= 20) | canonical & (n < 100) & (n % 10 == 0), _below_hundred(F.least(n, F.lit(99)))).when(plain == "100", "hundred").when(plain == "1000", "thousand")
    for ordinal, word in ORDINALS.items():
        out = out.when(plain == ordinal, word)
    number = plain.rlike("^[0-9]+$")
    out = out.when(plain.rlike("^(19|20)[0-9]{2}$"), year).when(number & (n > 20) & (n < 100), _below_hundred(n)).when(number & (n > 100) & (n < 1000), F.concat(hundreds, rest))
    return out.otherwise(digits)


def normalize_words(text: Column, lexicon: Column | None = None) -> Column:
    """Lower-case words of a cue without tags, dashes and punctuation, contractions and numbers written out; only those in `lexicon` (an array) if one is given."""
    out = F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", ""), r"\{[^}]+\}", "")
    for old in ("\n", "...", "…"):
        out = F.replace(out, F.lit(old), F.lit(" "))
    out = F.lower(F.regexp_replace(F.regexp_replace(out, "^- ", ""), " - ", " "))
    for short, full in CONTRACTIONS.items():
        out = F.regexp_replace(out, rf"(?U)\b{short}\b", full)
    # numbers are written out word by word: pieces keep everything around them
    pieces = F.regexp_extract_all(out, F.lit(r"(?U)(\b\d+(?:,\d{3})*(?:st|nd|rd|th)?\b|\w+|[^\w])"), F.lit(1))
    out = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"^\d+(,\d{3})*(st|nd|rd|th)?$"), number_to_words(p)).otherwise(p)), "")
    out = F.regexp_replace(out, r"(?U)[^\w\s']", " ")
    out = F.regexp_replace(out, r"(?U)(?<!\w)'|'(?!\w)", " ")
    found = F.filter(F.split(strip(F.regexp_replace(out, r"(?U)\s+", " ")), " "), lambda w: w != "")
    if lexicon is not None:
        known = F.transform(found, lambda w: F.when(F.array_contains(lexicon, w), w).when(w.endswith("'s") & F.array_contains(lexicon, F.regexp_replace(w, "'s$", "")), F.regexp_replace(w, "'s$", "")))
        found = F.filter(known, lambda w: w.isNotNull())
    return F.array_join(found, " ")
