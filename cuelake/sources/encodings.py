"""Which encoding a file's bytes are in, by built-in functions.

A byte order mark, valid UTF-8, and every second byte zero (UTF-16) decide at once. Other
bytes are read in each of the 8-bit encodings in turn, and pairs of letters with a byte
over 127 are counted that are frequent in a language written with it, for the language
that has most; what an encoding has no character for, control characters, and signs or
capitals between small letters count against it. The best score tells, by confidence in thousandths: pairs met for each such
byte. Where no encoding scores, Latin-1 is taken, as with files that can't be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Frequent pairs with a letter beyond ASCII, by language; `_` is the end of a word.
WESTERN = {
    "fr": "én ér ée és éa éc éo él éd ém ét té né dé ré pé lé mé vé iè èr ès èm èn èt lè rè sè tè mè dè nè êt êm ên êc êv rê bê tê fê vê mê pê nç rç eç aç ça ço çu où là à_ ù_ ût oû aî aï ôt hô",
    "de": "ün ür üb üh fü mü zü äh är ät än wä hä mä ör ön öh hö kö sö aß oß uß iß",
    "es": "ño ña ñe añ ió ón ía ín ús ás ém én él ré té áb ár és",
    "pt": "ão çã õe ís ár ém és ên çõ ço ça ói úl íc ó_ ár nç",
    "nl": "ië eë oë ïe ün één ëi oö ën ïn",
    "nordic": "å_ på få år gå ær æl ør øj ød sø fø nå äl ä_ ö_ åt är än ät ön öj ör åg æn ån",
}
CENTRAL = {
    "pl": "ał ła ły ło ół ią ię ąc ąd ć_ ść śc że ży ów ńs eń śm ęt ęd ęp ą_ ę_ źn ór óż",
    "cs": "ře ří př tř ěj ně vě dě tě bě če či ač oč ži že až už ší še šk uš ův ůj ůl ům ým ký ný áš áv ťo ňo ná dá é_ ní",
    "hu": "ől ők ős tő nő bő lő űl űr tű mű ző én ér és ég ök öt ön öz él ál ár ás át ül ün",
    "ro": "ţi ţă ăr ăt şi eş aş oş să ră în ân",
}
#: What Latin-9 and Windows-1252 have where Latin-1 has signs or nothing.
ADDED = "œu cœ sœ vœ mœ œi €_ _€ éš aš ež až"

_HIGH = "".join(chr(b) for b in range(0x80, 0x100))
#: Points against an encoding for each character that it can't have or that is unlikely where it stands.
_MISSING, _CONTROL, _SIGN = 8, 4, 2


def _table(encoding: str) -> str:
    """What the bytes over 127 are in an encoding; a placeholder where it has nothing."""
    return "".join(bytes([b]).decode(encoding, "replace") for b in range(0x80, 0x100))


def _met(text: Column, pairs: str) -> Column:
    """How often the pairs of a language stand in a text; `_` is where a word, or a number before a sign, ends."""
    found = "|".join(p.replace("_", r"(?![\p{L}])" if p.endswith("_") else r"(?<=\d)") for p in pairs.split())
    return F.regexp_count(F.lower(text), F.lit(found))


def _against(text: Column) -> Column:
    signs = F.regexp_count(text, F.lit(r"(?<=\p{L})[\x{A1}-\x{BF}×÷˘˝˛ˇ‡†‰¤](?=\p{L})|(?<=\p{Ll})\p{Lu}(?=\p{Ll})"))
    return F.regexp_count(text, F.lit("�")) * _MISSING + F.regexp_count(text, F.lit(r"[\x{80}-\x{9F}]")) * _CONTROL + signs * _SIGN


#: Encodings in the order in which equal scores are taken: Latin-1 before those that add to it.
_CHOICE = ("iso-8859-1", "windows-1252", "iso-8859-15", "windows-1250")


def detect(files: DataFrame, column: str = "content") -> DataFrame:
    """files with their bytes in `column` read: encoding, confidence, and the text, without a byte order mark, in place of the bytes. A null is an empty file."""
    rest = [c for c in files.columns if c != column]
    raw = F.coalesce(F.col(column), F.lit(b""))
    # step by step, as each step is used many times
    own = files.select(*rest, raw.alias("_raw"), F.decode(raw, "ISO-8859-1").alias("_latin"), F.is_valid_utf8(raw.cast("string")).alias("_utf8"))
    zeros = F.length("_latin") - F.length(F.translate("_latin", "\0", ""))
    wide = (F.length("_latin") > 1) & (F.length("_latin") % 2 == 0) & (zeros * 5 >= F.length("_latin"))
    first = F.ascii(F.substring("_latin", 1, 1))
    own = own.withColumn("_wide", F.when(F.col("_latin").startswith("ÿþ"), "UTF-16LE").when(F.col("_latin").startswith("þÿ"), "UTF-16BE").when(wide, F.when(first == 0, "UTF-16BE").otherwise("UTF-16LE")))
    # halves of pairs that stand alone, or an odd byte, make no UTF-16; such a file is read byte by byte
    upper = F.regexp_replace("_latin", r"(?s)(.)(.)", F.when(F.col("_wide") == "UTF-16LE", "$2").otherwise("$1"))
    alone = F.regexp_replace(F.when(F.col("_wide").isNotNull(), upper).otherwise(""), r"[\x{D8}-\x{DB}][\x{DC}-\x{DF}]", "").rlike(r"[\x{D8}-\x{DF}]")
    own = own.withColumn("_wide", F.when((F.length("_latin") % 2 == 0) & ~alone, F.col("_wide")))
    bytes_only = F.when(F.col("_wide").isNull() & ~F.col("_utf8"), F.col("_latin")).otherwise("")
    for rank, e in enumerate(_CHOICE):
        own = own.withColumn(f"_read{rank}", bytes_only if e == "iso-8859-1" else F.translate(bytes_only, _HIGH, _table(e)))
    # of the languages of an encoding the one with most pairs counts; those of the west are written alike in three of them
    own = own.withColumn("_west", F.greatest(*[_met(F.col("_read0"), pairs) for pairs in WESTERN.values()]))
    own = own.withColumn("_central", F.greatest(*[_met(F.col(f"_read{_CHOICE.index('windows-1250')}"), pairs) for pairs in CENTRAL.values()]))
    scored = []
    for rank, e in enumerate(_CHOICE):
        read = F.col(f"_read{rank}")
        met = F.col("_central") if e == "windows-1250" else F.col("_west") if e == "iso-8859-1" else F.col("_west") + _met(read, ADDED)
        own = own.withColumn(f"_score{rank}", met - _against(read))
        scored.append(F.struct(F.col(f"_score{rank}").alias("score"), F.lit(-rank).alias("rank"), F.lit(e).alias("encoding"), read.alias("text")))
    own = own.withColumn("_best", F.array_max(F.array(*scored))).withColumn("_high", F.regexp_count("_read0", F.lit(r"[\x{80}-\x{FF}]")))
    known = F.col("_best.score") > 0
    sure = F.when(known, F.least(F.lit(1000), F.floor(F.col("_best.score") * 1000 / F.greatest("_high", F.lit(1))))).otherwise(0)
    little, big = F.col("_wide") == "UTF-16LE", F.col("_wide") == "UTF-16BE"
    text = F.when(little, F.decode(F.when(little, F.col("_raw")), "UTF-16LE")).when(big, F.decode(F.when(big, F.col("_raw")), "UTF-16BE")).when(F.col("_utf8"), F.col("_raw").cast("string")).when(known, F.col("_best.text")).otherwise(F.col("_latin"))
    encoding = F.when(F.col("_wide").isNotNull(), F.lower("_wide")).when(F.col("_utf8"), "utf-8").when(known, F.col("_best.encoding")).otherwise("iso-8859-1")
    return own.select(*rest, encoding.alias("encoding"), F.when(F.col("_wide").isNotNull() | F.col("_utf8"), 1000).otherwise(sure).cast("int").alias("confidence"), F.regexp_replace(text, "^﻿", "").alias(column))


def read_detected(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, encoding, confidence, content) of every .srt file, with the content as srt.parse takes it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.srt").load(path)
    return detect(files.select("path", "content"))
