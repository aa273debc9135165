"""Licence scan by canonical digests, on built-in functions alone.

A text is brought to a canonical form (lower case, no copyright lines, words
only, one spelling) and its SHA-256 is joined to the digests of known licences.
Entire texts are looked up: the whole document, and each of its lines as a text
of its own, which finds one-line notices and identifiers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.known_licenses import DIGESTS, KNOWN, SPELLINGS

COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n©(]*(copyright|©|\(c\))[^\n]*$|\ball rights reserved\b"
NOT_WORD = r"[^\p{L}\p{N}\n]+"
ANY_SPELLING = r"\b(" + "|".join(old for old, _ in SPELLINGS) + r")\b"
#: A list of more digests than this is shuffled to the units, not sent to all tasks.
BROADCAST_DIGESTS = 100_000
#: Parts that a digest with very many units is dealt to when the list is shuffled.
SALTS = 32


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once, however often it is used.

    Spark copies the expression of a projected column into each of its uses; it
    does not do so through a generator.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def with_canonical_lines(rows: DataFrame, text: str) -> DataFrame:
    """Add ``lines``: the canonical form, line by line; lines keep their places."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), NOT_WORD, " ")
    rows = _once(rows, "words", plain)
    spelled = F.col("words")
    for old, new in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{old}\b", new)
    # Few texts have another spelling; one look spares the others the replacements.
    form = F.when(F.col("words").rlike(ANY_SPELLING), spelled).otherwise(F.col("words"))
    return _once(rows, "lines", form).drop("words")


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def text_digests(texts: DataFrame) -> DataFrame:
    """Columns license and digest for a table of licence texts (license, text) of any size."""
    own = texts.select("license", "text").filter("text IS NOT NULL")
    form = one_line(F.col("lines"))
    rows = with_canonical_lines(own, "text").select("license", form.alias("form"))
    return rows.filter("form <> ''").select("license", F.sha2("form", 256).alias("digest"))


def known_digests(
    spark: SparkSession,
    known: Sequence[tuple[str, str]] = KNOWN,
    digests: Sequence[tuple[str, str]] = DIGESTS,
) -> DataFrame:
    """One row per licence and digest of the licences listed here."""
    texts = spark.createDataFrame(list(known), "license string, text string")
    listed = spark.createDataFrame(list(digests), "license string, digest string")
    return text_digests(texts).union(listed).distinct()


def license_scan(
    docs: DataFrame,
    digests: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents with known licences: doc_id, scope (``text`` or ``line``), license, places.

    ``places`` counts the lines (or whole texts, 1) that are the licence. A
    one-line text counts as ``text`` and as ``line``. ``digests`` is a table
    (license, digest) of any size, by default the licences listed here; make one
    of licence texts by ``text_digests``. Its size is looked at: a small one goes
    to all tasks, a larger one is shuffled, with hot digests dealt to ``SALTS``
    parts. A null digest matches nothing. Null and empty texts match nothing. A
    null id is kept as null. Repeated rows count together. Other columns are not
    looked at. An empty table gives no rows.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    lines = with_canonical_lines(named.filter("text IS NOT NULL"), "text")
    # The whole text is unit 0 and its lines follow, so that texts are read once.
    units = lines.select(
        "doc_id",
        F.posexplode(F.concat(F.array(one_line(F.col("lines"))), F.split("lines", "\n"))),
    )
    unit = F.trim("col")
    # Never null: else the join would add a filter with a second digest of each unit.
    digest = F.coalesce(F.sha2(unit, 256), F.lit(""))
    found = units.filter(unit != "").select(
        "doc_id",
        F.when(F.col("pos") == 0, "text").otherwise("line").alias("scope"),
        digest.alias("digest"),
    )
    if digests is None:
        table = known_digests(docs.sparkSession)
    else:
        table = digests.select("license", "digest").filter("digest IS NOT NULL").distinct()
    if table.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        joined = found.join(F.broadcast(table), "digest")
    else:
        found = found.groupBy("doc_id", "scope", "digest").agg(F.count("*").alias("times"))
        found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "scope"), F.lit(SALTS)))
        salted = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = found.join(salted, ["digest", "salt"])
        return joined.groupBy("doc_id", "scope", "license").agg(F.sum("times").alias("places"))
    return joined.groupBy("doc_id", "scope", "license").agg(F.count("*").alias("places"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(
    known: Sequence[tuple[str, str]] = KNOWN, digests: Sequence[tuple[str, str]] = DIGESTS
) -> str:
    """The same scan in SQL."""

    def lines(text: str) -> str:
        form = f"regexp_replace(lower({text}), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
        form = f"regexp_replace({form}, {_quoted(NOT_WORD)}, ' ', 'g')"
        for old, new in SPELLINGS:
            form = f"regexp_replace({form}, {_quoted(rf'\b{old}\b')}, {_quoted(new)}, 'g')"
        return form

    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    listed = ", ".join(f"({_quoted(name)}, {_quoted(digest)})" for name, digest in digests)
    return f"""
        WITH known AS (
            SELECT license,
                   sha256(trim(regexp_replace({lines("body")}, '\\s+', ' ', 'g'))) AS digest
            FROM (VALUES {rows}) AS k(license, body)
            UNION
            SELECT license, digest FROM (VALUES {listed}) AS k(license, digest)
        ), docs AS (SELECT doc_id, {lines("text")} AS lines FROM documents),
        units AS (
            SELECT doc_id, 'text' AS scope,
                   trim(regexp_replace(lines, '\\s+', ' ', 'g')) AS form FROM docs
            UNION ALL
            SELECT doc_id, 'line', trim(unnest(string_split(lines, chr(10)))) FROM docs
        )
        SELECT doc_id, scope, license, count(*) AS places
        FROM units JOIN known ON sha256(form) = digest WHERE form <> ''
        GROUP BY doc_id, scope, license
    """
