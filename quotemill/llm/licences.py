"""Licence scans by canonical digests.

A text is brought to a canonical form: case, punctuation, white space, copyright lines and
equivalent spellings are levelled. The digest of the whole form is joined with the digests of known
licences. A licence is looked for at two grains: the whole document, and each of its lines as a
whole text (notices such as "Released under the MIT License.").

All of it is DataFrame functions; the table of known digests is a parameter, bounded, and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.licence_texts import KNOWN, published

#: Known licences are a table to look up in; more than this many would not be broadcast.
BROADCAST_LICENCES = 100_000

# Spellings that count as the same, American first (from the public guidelines for
# matching licence texts).
SPELLINGS = (
    ("acknowledgment", "acknowledgement"),
    ("analog", "analogue"),
    ("analyze", "analyse"),
    ("artifact", "artefact"),
    ("authorization", "authorisation"),
    ("authorized", "authorised"),
    ("center", "centre"),
    ("customization", "customisation"),
    ("favorite", "favourite"),
    ("fulfill", "fulfil"),
    ("initialize", "initialise"),
    ("judgment", "judgement"),
    ("labeling", "labelling"),
    ("license", "licence"),
    ("maximize", "maximise"),
    ("modeled", "modelled"),
    ("noncommercial", "non commercial"),
    ("organization", "organisation"),
    ("organize", "organise"),
    ("percent", "per cent"),
    ("practice", "practise"),
    ("program", "programme"),
    ("realize", "realise"),
    ("recognize", "recognise"),
    ("sublicense", "sub license"),
    ("utilization", "utilisation"),
    ("while", "whilst"),
    ("willful", "wilful"),
)

#: Lines that state a copyright: the word, or a sign for it, with a year, a sign or a placeholder;
#: or, where a paragraph begins, with a name.
RIGHTS = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:"
    r"(?i:copyright\b[\s:,]*(?:\(c\)|©|\d{4}|[<\[{]).*|©.*|\(c\)[\s:,]*(?:copyright\b|\d{4}|[<\[{]).*"
    r"|all rights reserved[^\p{L}\p{N}\n]*)"
    r"|(?:(?<=\A|\n\n)|(?<=\n\n[ \t]{1,40}))Copyright[ \t:]+(?:by[ \t]+)?"
    r"(?!(?i:holder|notice|licen[sc]|owner|law|act|and|or|in|the|is)\w*\b)\p{Lu}\p{Ll}.*"
    r")$"
)


def canonical_lines(text: Column) -> Column:
    """The canonical form as an array of lines. Null text: an array of none.

    Lines that state a copyright, or that all rights are reserved, are left out, and so are lines
    without a letter or digit. Other lines stay, also where they begin with "copyright".
    """
    text = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "\r\n?", "\n")
    text = F.regexp_replace(text, RIGHTS, "")
    text = F.lower(text)
    text = F.replace(text, F.lit("https://"), F.lit("http://"))
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    for american, british in SPELLINGS:
        text = F.replace(text, F.lit(british), F.lit(american))
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def _digests(lines: Column) -> Column:
    """Digest of the whole text, then of each line, by grain."""
    whole = F.struct(F.lit("text").alias("grain"), F.sha2(F.array_join(lines, " "), 256).alias("digest"))
    single = F.transform(
        F.array_distinct(lines),
        lambda line: F.struct(F.lit("line").alias("grain"), F.sha2(line, 256).alias("digest")),
    )
    return F.concat(F.array(whole), single)


def known_licences(spark: SparkSession) -> DataFrame:
    """Short texts and the whole published ones, each also with or without its title."""
    return spark.createDataFrame(sorted([*KNOWN.items(), *published()]), "licence string, text string")


def known_digests(licences: DataFrame) -> DataFrame:
    """(digest, licence): one row per canonical text; of equal texts the first name. A licence whose
    canonical text is empty is left out, as it would match all empty documents."""
    form = F.array_join(canonical_lines(F.col("text")), " ")
    named = licences.filter(F.col("licence").isNotNull()).select("licence", form.alias("form"))
    digests = named.filter(F.col("form") != "").groupBy(F.sha2("form", 256).alias("digest"))
    return digests.agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, licences: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, ``digest`` (of the whole canonical text), ``licence`` (whose
    text the whole document is, or null) and ``notices`` (licences of which a line is the whole
    text, sorted).

    Null, empty and wordless texts have the digest of the empty text and no licence. Repeated rows
    and null keys each give a row. Empty table: empty result. Other columns are ignored.
    """
    known = known_digests(licences)
    if known.count() <= BROADCAST_LICENCES:
        known = F.broadcast(known)
    lines = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        canonical_lines(F.col(f"`{text}`")).alias("lines"),
    )
    units = lines.select("key", "row", F.explode(_digests(F.col("lines"))).alias("unit"))
    units = units.select("key", "row", "unit.grain", "unit.digest")
    found = units.join(known, "digest", "left")
    whole = F.col("grain") == "text"
    rows = found.groupBy("row").agg(
        F.max(F.when(whole, F.col("key"))).alias("key"),
        F.max(F.when(whole, F.col("digest"))).alias("digest"),
        F.max(F.when(whole, F.col("licence"))).alias("licence"),
        F.sort_array(F.collect_set(F.when(~whole, F.col("licence")))).alias("notices"),
    )
    return rows.select(F.col("key").alias(key), "digest", "licence", "notices")
