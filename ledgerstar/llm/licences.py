"""Licence scan by canonical digests.

A text is brought into canonical form: lower case, copyright lines dropped, equivalent spellings made
equal, everything but letters and digits one space. The digest of the whole canonical text is joined with
the digests of known licences. Single lines that name a licence are looked up the same way among known
notices. DataFrame expressions only; texts are neither shuffled nor broadcast, the known texts are a small
parameter table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm.common import ident
from ledgerstar.llm.licence_texts import LICENCES, NOTICES, SPELLINGS

COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """The canonical form; NULL stays NULL."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for other, usual in SPELLINGS:
        t = F.replace(t, F.lit(other), F.lit(usual))
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """(digest, licence) of known texts; texts that differ only in form keep the first name by code point."""
    rows = spark.createDataFrame(sorted(texts.items()), "licence string, body string")
    return rows.select(digest(F.col("body")).alias("digest"), "licence").groupBy("digest").agg(F.min("licence").alias("licence"))


def _spellings(word: str) -> list[str] | None:
    """How a word of a canonical form can stand in a lower-case text; None: not as a word of its own."""
    found = [word]
    for w in found:
        for other, usual in SPELLINGS:
            if usual in w and other.isalpha():
                found += [x for x in [w.replace(usual, other)] if x not in found]
    parts = {p for other, usual in SPELLINGS if not other.isalpha() for p in re.findall(r"[^\W_]+", usual)}
    return None if any(p in word for p in parts) else found


def _may_be(text: Column, forms: list[str]) -> Column:
    """Whether a lower-case text may hold one of the canonical forms: it has the two longest words of one."""
    anyway = F.lit(False)
    for form in forms:
        words = sorted((x for w in set(form.split()) if (x := _spellings(w))), key=lambda x: (-len(x[0]), x[0]))[:2]
        both = F.lit(True)
        for x in words:
            both = both & reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in x])
        anyway = anyway | both
    return anyway


def scan(df: DataFrame, licences: DataFrame | None = None, notices: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, licence (NULL: the text is no known licence), notices (names of known notice lines).

    ``licences``: (digest, licence), one row per digest; the default is the built-in table. NULL texts have
    a NULL digest, match nothing and have no notices; texts without letters or digits have the digest of
    the empty text, which is in no table. Repeated rows are each returned; other columns are ignored.
    """
    spark = df.sparkSession
    licences = known(spark, LICENCES) if licences is None else licences
    notices = NOTICES if notices is None else notices
    lines = known(spark, notices).collect()  # the fixed notices
    forms = sorted({r[0] for r in spark.createDataFrame([(x,) for x in notices.values()], "x string").select(canonical(F.col("x"))).collect()})
    name_of = F.create_map(*[F.lit(x) for r in lines for x in (r["digest"], r["licence"])]) if lines else None
    text = ident(text_col).cast("string")
    candidates = F.filter(F.split(text, "\n"), lambda x: _may_be(F.lower(x), forms))
    found = (F.array_sort(F.array_distinct(F.array_compact(F.transform(candidates, lambda x: name_of[digest(x)]))))
             if name_of is not None else F.array().cast("array<string>"))
    notices_col = F.when(_may_be(F.lower(text), forms), F.array_join(found, ",")).otherwise("")
    rows = df.select(ident(id_col).alias("id"), digest(text).alias("digest"), F.coalesce(notices_col, F.lit("")).alias("notices"))
    named = licences.select(F.col("digest").alias("d"), F.col("licence"))
    return (rows.join(named, F.col("digest") == F.col("d"), "left")
            .select(F.col("id").alias(id_col), "digest", "licence", "notices"))


def _sql_canonical(x: str) -> str:
    x = f"regexp_replace(lower({x}), '(?m)^[^\\p{{L}}\\p{{N}}\\n]*(?:copyright\\b|\\(c\\)|©|all rights reserved)[^\\n]*$', '', 'g')"
    for other, usual in SPELLINGS:
        x = f"replace({x}, '{other}', '{usual}')"
    return f"trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"


def oracle() -> str:
    """The same scan as DuckDB SQL."""
    def values(texts: dict[str, str]) -> str:
        return ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(texts.items()))
    return f"""
WITH lic AS (SELECT sha256({_sql_canonical('body')}) AS digest, min(licence) AS licence FROM (VALUES {values(LICENCES)}) v(licence, body) GROUP BY 1),
note AS (SELECT sha256({_sql_canonical('body')}) AS digest, min(licence) AS licence FROM (VALUES {values(NOTICES)}) v(licence, body) GROUP BY 1),
line AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents),
named AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
          FROM line JOIN note ON sha256({_sql_canonical('x')}) = note.digest WHERE regexp_matches(lower(x), 'licen[cs]') GROUP BY doc_id)
SELECT d.doc_id, sha256({_sql_canonical('d.text')}) AS digest, lic.licence, coalesce(named.notices, '') AS notices
FROM documents d LEFT JOIN lic ON sha256({_sql_canonical('d.text')}) = lic.digest LEFT JOIN named ON d.doc_id = named.doc_id
"""
