"""Texts of ten languages in the encodings that can hold them."""

import pytest
from pyspark.sql import functions as F

from cuelake.sources import encodings, srt

TEXTS = {
    "fr": "Où est passé le garçon ? Il était très fatigué à la forêt, voilà tout. Ça ne m'a pas gêné.",
    "de": "Für die Mädchen wäre es schön, über die Brücke zu gehen. Das heißt, wir müssen hören.",
    "es": "Mañana será otro día. El niño comió una canción, según él mismo. ¿Qué más?",
    "pt": "As informações não são boas. A educação dos irmãos é a solução.",
    "nl": "De financiën van België zijn geëindigd, zei één Belgische coördinator. Oekraïense ruïnes.",
    "sv": "Det är på tiden att vi går hem för att äta. Han får vänta några år på sjön.",
    "pl": "Chciałbym, żeby wszyscy ludzie byli szczęśliwi. Książka leży na stole, a światło już zgasło. Są święta.",
    "cs": "Příliš žluťoučký kůň úpěl ďábelské ódy. Řekni mi, proč už nemůžeš přijít ještě dnes.",
    "hu": "A nők és a férfiak együtt nőttek fel. Ez a könyv jövőre jelenik meg, időben és térben külső erővel.",
    "oe": "Le cœur de ma sœur bat. Une œuvre à 15 €, un nœud, des mœurs et un bœuf.",
}
BLOCK = "{n}\r\n00:00:0{n},000 --> 00:00:0{n},900\r\n{text}\r\n\r\n"


def cases():
    for name, text in TEXTS.items():
        whole = "".join(BLOCK.format(n=n, text=text) for n in (1, 2))
        western = name in ("fr", "de", "es", "pt", "nl", "sv")
        yield name, whole, "utf-8", whole.encode()
        yield name, whole, "utf-8", b"\xef\xbb\xbf" + whole.encode()
        yield name, whole, "utf-16le", b"\xff\xfe" + whole.encode("utf-16le")
        yield name, whole, "utf-16be", whole.encode("utf-16be")
        yield name, whole, "utf-16le", whole.encode("utf-16le")
        if western:
            yield name, whole, "iso-8859-1", whole.encode("latin-1")
            paired = whole.replace(".", " 🙂.")
            yield name, paired, "utf-16be", paired.encode("utf-16be")
            yield name, paired, "utf-16le", b"\xff\xfe" + paired.encode("utf-16le")
            quoted = whole.replace("00:00:01,900\r\n", "00:00:01,900\r\n“Ja” – ")
            yield name, quoted, "windows-1252", quoted.encode("cp1252")
        elif name == "oe":
            yield name, whole, "windows-1252", whole.encode("cp1252")
            yield name, whole, "iso-8859-15", whole.encode("iso-8859-15")
        else:
            yield name, whole, "windows-1250", whole.encode("cp1250")


def test_languages(spark):
    rows = list(cases())
    df = encodings.detect(spark.createDataFrame([(k, bytes(r[3])) for k, r in enumerate(rows)], "k int, b binary"), "b")
    for r in df.collect():
        name, text, encoding, _ = rows[r["k"]]
        assert (name, r["encoding"], r["b"]) == (name, encoding, text)
        assert 0 < r["confidence"] <= 1000


@pytest.mark.parametrize("raw", [b"", None, b"plain", b"\xff", b"a\x00", b"\xa4\xa4 \x81", "だ".encode("shift_jis"), b"\xff\xfe\x00\xd8A\x00", b"\xff\xfeA", b"\xfe\xff\xdc\x00"])
def test_odd_bytes(spark, raw):
    d = encodings.detect(spark.createDataFrame([(raw,)], "b binary"), "b").first()
    assert d["encoding"] and d["b"] is not None and 0 <= d["confidence"] <= 1000
    if raw and raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        assert d["encoding"] == "iso-8859-1"  # halves of pairs that stand alone, an odd byte
    if raw in (b"", None, b"plain"):
        assert (d["encoding"], d["b"]) == ("utf-8", (raw or b"").decode())


def test_files(spark, tmp_path):
    for k, (name, _, _, raw) in enumerate(cases()):
        (tmp_path / f"{name}{k}.nl.srt").write_bytes(raw)
    files = encodings.read_detected(spark, str(tmp_path))
    parsed = srt.parse(files.select(F.col("path").alias("title_id"), "content"))
    assert parsed.count() == 2 * len(list(cases())) and srt.parse_errors(files.select(F.col("path").alias("title_id"), "content")).count() == 0
