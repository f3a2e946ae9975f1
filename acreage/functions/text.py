"""Text expressions: normal form, categories, labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MISSING, BLANK = "<PANDAS_NA>", "<BLANK_STRING>"
#: The patterns of the note field, for profiling only; several can fit one note.
NOTE_PATTERNS = {
    "related_party": "親友|員工|共有人|特殊關係",
    "renovation_or_furniture": "裝潢|裝修|家具|家電",
    "addition_or_unregistered": "增建|未登記|頂樓加蓋|陽台外推|夾層",
    "tenancy": "租約|租賃",
    "distressed_or_defect": "急買|急賣|瑕疵",
    "redevelopment": "都更|重建",
}


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s.strip()))


def normalize_text(c: Column | str) -> Column:
    """Strip Unicode blanks, then NFKC, then '' becomes null. ASCII texts never leave the JVM's path."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    ascii_only = F.octet_length(c) == F.length(c)
    plain = F.regexp_replace(c, r"^[\x09-\x0d\x1c-\x20]+|[\x09-\x0d\x1c-\x20]+$", "")
    return F.nullif(F.when(ascii_only, plain).otherwise(_nfkc(F.when(~ascii_only, c))), F.lit(""))


def tri_state(c: Column, yes: str, no: str) -> Column:
    return F.when(c == yes, True).when(c == no, False)


def keyword_category(c: Column, keywords: Sequence[str], other: str) -> Column:
    """The last keyword of the list that occurs; other for any other text; null stays null."""
    out = F.when(c.isNotNull(), F.lit(other))
    for word in keywords:
        out = F.when(c.contains(word), F.lit(word)).otherwise(out)
    return out


def label_missing(c: Column) -> Column:
    return F.when(c.isNull(), MISSING).when(F.trim(c) == "", BLANK).otherwise(c)


def pattern_flags(c: Column, patterns: Mapping[str, str] = NOTE_PATTERNS) -> dict[str, Column]:
    return {name: F.coalesce(c.rlike(p), F.lit(False)) for name, p in patterns.items()}


def digit_length(c: Column) -> Column:
    return F.length(c.cast("bigint").cast("string"))
