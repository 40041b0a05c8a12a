"""Vocabularies and phrases as tables, looked up in the words of cues.

Words of cues are exploded with their place. A vocabulary is met in three steps: a
blocked Bloom filter (one row of 64 bits for each 64 / BITS_A_WORD words, three bits a
word) lets words pass that may be known, if it is small enough to be broadcast, which is
checked; the distinct words that pass are joined with the vocabulary, so that a frequent
word is one row; what is known then goes back to the places of words, dealt over SALTS
copies, as a frequent word has many places.

Phrases are met as n-grams: for each length that phrases have, the n-grams of cues are
joined with the phrases of that length. Where hits of a cue overlap the leftmost counts,
of those the longest; the next one begins after it.

Words are compared as they are; fold case before. A null list has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each word, rows up to which it is broadcast, and copies of known words.
BITS_A_WORD, BROADCAST_ROWS, SALTS = 16, 1_000_000, 16

KEY = ["title_id", "pos"]


def _bits(word: Column) -> Column:
    h = F.xxhash64(word, F.lit(1))
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int")).bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.shiftright(h, 16), F.lit(64)).cast("int"))).bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")))


def bloom(vocabulary: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the distinct words of a vocabulary (word)."""
    return vocabulary.groupBy(F.pmod(F.xxhash64("word"), F.lit(blocks)).alias("block")).agg(F.bit_or(_bits(F.col("word"))).alias("bits"))


def _may_be_known(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Without most words that the vocabulary lacks; all others stay."""
    blocks = max(1, -(-vocabulary.count() * BITS_A_WORD // 64))
    if blocks > BROADCAST_ROWS:
        return words
    own = words.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)))
    return own.join(F.broadcast(bloom(vocabulary, blocks)), "block").where(_bits(F.col("word")).bitwiseAND(F.col("bits")) == _bits(F.col("word"))).drop("block", "bits")


def known_words(cues: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(title_id, pos, words) for each cue with an array `words`: those that the vocabulary (word) has, in their order; an empty array where it has none."""
    listed = vocabulary.select("word").where("word is not null").distinct()
    placed = cues.select(*KEY, F.posexplode("words").alias("place", "word")).where("word is not null")
    may = _may_be_known(placed, listed)
    known = may.select("word").distinct().join(listed, "word", "left_semi")
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = may.withColumn("salt", F.pmod(F.xxhash64(*KEY, "place"), F.lit(SALTS)).cast("int")).join(salted, ["word", "salt"])
    # words of a cue, with a row for each cue so that those without known words stay
    whole = met.select(*KEY, "place", "word").unionByName(cues.select(*KEY, F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("word")))
    held = F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("place", "word"))))
    return whole.groupBy(*KEY).agg(F.transform(held, lambda x: x["word"]).alias("words"))


def phrase_hits(cues: DataFrame, phrases: DataFrame) -> DataFrame:
    """(title_id, pos, place, n, phrase, kinds): where phrases (phrase, kind; words with one space between) stand in the words of cues, place from 0; of overlapping ones the leftmost, then longest. A phrase of several kinds is one hit with all of them in order."""
    listed = phrases.where("phrase <> ''").groupBy("phrase").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).withColumn("n", F.size(F.split("phrase", " ")))
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())  # a handful of lengths
    words = cues.select(*KEY, "words").where(F.size("words") > 0)
    if not lengths:
        return words.where("false").select(*KEY, F.lit(0).alias("place"), F.lit(0).alias("n"), F.lit("").alias("phrase"), F.array(F.lit("")).alias("kinds"))
    # of each length the n-grams of a cue, as rows
    starts = F.array(*[F.struct(F.lit(n).alias("n"), (F.size("words") - n).alias("last")) for n in lengths])
    grams = words.withColumn("s", F.explode(F.filter(starts, lambda s: s["last"] >= 0))).withColumn("place", F.explode(F.sequence(F.lit(0), F.col("s.last"))))
    grams = grams.select(*KEY, "place", F.col("s.n").alias("n"), F.array_join(F.slice("words", F.col("place") + 1, F.col("s.n")), " ").alias("phrase"))
    met = grams.join(listed, ["phrase", "n"])
    hit = F.struct("place", (-F.col("n")).alias("shorter"), "phrase", "kinds")
    found = met.groupBy(*KEY).agg(F.array_sort(F.collect_list(hit)).alias("hits"))  # of one cue
    kind = "array<struct<place: int, shorter: int, phrase: string, kinds: array<string>>>"
    state = F.struct(F.lit(0).alias("after"), F.array().cast(kind).alias("taken"))

    def take(s: Column, h: Column) -> Column:
        return F.when(h["place"] >= s["after"], F.struct((h["place"] - h["shorter"]).alias("after"), F.concat(s["taken"], F.array(h)).alias("taken"))).otherwise(s)

    taken = found.select(*KEY, F.explode(F.aggregate("hits", state, take, lambda s: s["taken"])).alias("h"))
    return taken.select(*KEY, "h.place", (-F.col("h.shorter")).alias("n"), "h.phrase", "h.kinds")
