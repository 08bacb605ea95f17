"""Licence scan: look up canonical digests of whole texts among those of known licences.

A text's canonical form has its letters lowered, copyright lines left out, variant
spellings made one, bullets and numbers of lists taken off, and punctuation and white
space turned into single spaces. It is made of paragraphs and not of lines, so it is the
same however the text is wrapped, indented or commented. A text with copyright lines also
has a form that keeps them, for texts in which such a line was joined to its neighbours.

The digests of both forms are joined to those of the known texts. The whole document is
looked up, and so is each of its lines and paragraphs as a text of its own, which finds
notices. A paragraph ends at a copyright line and at one without words.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.llm.common import small
from asterism.llm.license_texts import TEXTS
from asterism.operators.lookup import BROADCAST_LIMIT, table_bytes
from asterism.sources.staging import stage

# Equivalent spellings of the public matching guidelines, as parts of
# lowered words, and then as words of a form without punctuation.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authoris", "authoriz"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalis", "capitaliz"),
    ("catalogue", "catalog"),
    ("categoris", "categoriz"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("fulfill", "fulfil"),
    ("https:", "http:"),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximis", "maximiz"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimis", "optimiz"),
    ("organis", "organiz"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realis", "realiz"),
    ("recognis", "recogniz"),
    ("signalling", "signaling"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
)
PHRASES = (
    ("copyright owner", "copyright holder"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("wish list", "wishlist"),
)
# what comments and bullets put before the words of a line
DECORATION = r"^[\x00-\x20*#/;!%|>=_+~•·-]+"
# a lowered line, without decoration, that tells whose the text is
COPYRIGHT_LINE = (
    r"^(?:copyright[\x00-\x20:]*(?:\(c\)|©|by[\x00-\x20]|[\[<{(]*(?:[0-9]{4}|yyyy|19yy|years?[\]>})]))"
    r"|©|\(c\)[\x00-\x20]*(?:copyright|[\[<{(]*(?:[0-9]{4}|yyyy))"
    r"|all rights reserved[.!]*[\x00-\x20*/#]*$)"
)
# numbers and letters of list items, where a paragraph begins or a clause has ended
ITEM = (
    r"(^|[a-z0-9)\x22”]{2}[.;:](?:[\x00-\x20]+(?:and|or))?[\x00-\x20]+)"
    r"(?:[(\[]?(?:[0-9]{1,2}(?:\.[0-9]{1,2})*|[a-z]|[ivx]{2,4})[.)\]:]+[\x00-\x20]+)+"
)
# what every item ends in: seeks its last signs, of which a text has few
ITEM_END = r"[.)\]:][\x00-\x20](?<=(?:[0-9ivx.)\]:]|(?:^|[\x00-\x20(\[])[a-z])[.)\]:][\x00-\x20])"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—…•·©]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—…•·©]"
# the same for lowered texts: at letters and digits, most of a text, a look at one table is enough
_PUNCTUATION = rf"(?=\P{{Alnum}}){PUNCTUATION}"
BREAK = " ?\n[ \n]*"
_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# letters and signs of the spellings, rare ones first
_RARE = ":zqxjkvbpygfwmucldrhsnioate "


def _any_of(words: Iterable[str]) -> str:
    """A pattern with a match in every text that holds one of ``words``, and in no other. Each is
    sought by its rarest letter, so that most places of a text fail at once."""
    ends: dict[str, list[str]] = {}
    for word in words:
        at = min(range(len(word)), key=lambda i: _RARE.index(word[i]))
        ends.setdefault(word[at], []).append(f"{word[at + 1:]}(?<={word})")
    branches = [f"{letter}(?:{'|'.join(of)})" for letter, of in ends.items()]
    return f"(?=[{''.join(ends)}])(?:{'|'.join(branches)})"


def _respelled(texts: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Texts of an array with one of each pair put for the other; those that hold none stay as they are."""
    others = _any_of(other for other, _ in pairs)

    def respelled(text: Column) -> Column:
        new = text
        for other, ours in pairs:
            new = F.replace(new, F.lit(other), F.lit(ours))
        return F.when(text.rlike(others), new).otherwise(text)

    return F.transform(texts, respelled)


def _canonical(parts: Column) -> Column:
    """Canonical forms of lowered lines or paragraphs."""

    def words(part: Column) -> Column:
        form = F.when(part.rlike(ITEM_END), F.regexp_replace(F.trim(part), ITEM, "$1")).otherwise(part)
        return F.trim(F.regexp_replace(form, _PUNCTUATION, " "))

    return _respelled(F.transform(parts, words), PHRASES)


def _paragraphs(lines: Column) -> Column:
    """Canonical paragraphs of lines, of which some are but a line feed. Others have none."""
    joined = F.array_join(lines, " ")
    return F.filter(_canonical(F.split(joined, BREAK, -1)), lambda part: part != "")


def forms(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and, for the text of each row: ``digest`` of its canonical form, ``as_is``, that
    with its copyright lines (null if it has none), and ``parts``, those of its lines and
    paragraphs, as bytes."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), _ASCII_UPPER, _ASCII_LOWER)
    lines = _respelled(F.split(lowered, "\n", -1), SPELLINGS)
    lines = F.transform(lines, lambda line: F.regexp_replace(line, DECORATION, ""))
    rows = texts.select(*keep, lines.alias("_lines"))
    rows = rows.select(*keep, "_lines", F.transform("_lines", lambda line: line.rlike(COPYRIGHT_LINE)).alias("_owned"))

    def where_words(line: Column) -> Column:
        return F.when(line.rlike(WORDS), line).otherwise("\n")

    kept = F.zip_with("_lines", "_owned", lambda line, owned: F.when(owned, "\n").otherwise(where_words(line)))
    rows = rows.select(*keep, "_lines", "_owned", kept.alias("_kept"))
    rows = rows.select(
        *keep,
        F.when(
            F.array_contains("_owned", True),
            F.md5(F.array_join(_paragraphs(F.transform("_lines", where_words)), " ")),
        ).alias("as_is"),
        _canonical(F.filter("_kept", lambda line: line != "\n")).alias("_single"),
        _paragraphs(F.col("_kept")).alias("_paragraphs"),
    )
    parts = F.array_distinct(F.concat("_single", "_paragraphs"))
    return rows.select(
        *keep,
        F.md5(F.array_join("_paragraphs", " ")).alias("digest"),
        "as_is",
        F.transform(parts, lambda part: F.unhex(F.md5(part))).alias("parts"),
    )


def text_table(spark: SparkSession, texts: dict[str, list[str]] = TEXTS) -> DataFrame:
    """(name, text) of texts by name."""
    rows = [(name, text) for name, of in texts.items() for text in of]
    return spark.createDataFrame(rows, "name string, text string")


def known_digests(table: DataFrame) -> DataFrame:
    """(known, name): the digests that stand for the texts of a table (name, text). Of
    two names for one digest the first in order stays; texts without words have none."""
    rows = forms(table.where("name is not null and text is not null"), "name")
    rows = rows.select("name", F.explode(F.array_distinct(F.array("digest", F.coalesce("as_is", "digest")))).alias("known"))
    rows = rows.where(F.col("known") != F.md5(F.lit("")))
    return stage(rows.groupBy("known").agg(F.min("name").alias("name")))


def license_scan(docs: DataFrame, texts: dict[str, list[str]] | DataFrame = TEXTS) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, digest of the canonical text,
    license (that of the whole text, or null) and notices (names of the licences that
    lines or paragraphs give, sorted, separated by commas; empty if none). ``texts``
    are the known ones, by name or as a table (name, text) of any size.

    A null text counts as empty and has the digest of the empty text, which is no
    licence. Repeated rows stay apart; one line in many copies names its licence once.
    """
    spark = docs.sparkSession
    known = known_digests(texts if isinstance(texts, DataFrame) else text_table(spark, texts))
    rows = stage(forms(docs.select("doc_id", "text"), "doc_id").withColumn("_row", F.monotonically_increasing_id()))
    parts = rows.select("_row", F.explode("parts").alias("part"))
    if table_bytes(known) > BROADCAST_LIMIT:  # only what is asked for: a row for each licence that is there
        asked = rows.select(F.explode(F.array("digest", "as_is")).alias("known")).unionAll(
            parts.select(F.lower(F.hex("part")).alias("known"))
        )
        known = stage(known.join(asked.distinct(), "known", "left_semi"))
    known = small(known)
    hits = parts.join(known.withColumn("part", F.unhex("known")).drop("known"), "part")
    notices = hits.groupBy("_row").agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("notices"))
    whole = rows.select("_row", "doc_id", "digest", "as_is")
    for form in ("digest", "as_is"):
        names = known.select(F.col("known").alias(form), F.col("name").alias(f"_{form}"))
        whole = whole.join(names, form, "left")
    return whole.join(small(stage(notices)), "_row", "left").select(
        "doc_id",
        "digest",
        F.coalesce("_digest", "_as_is").alias("license"),
        F.coalesce("notices", F.lit("")).alias("notices"),
    )
