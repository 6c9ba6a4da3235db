"""Company ids, trigram similarity, tokens and pattern extraction, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns for company ids, money and dates in notices.
COMPANY_ID = r"\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}"
MONEY = r"R\$ ?\d{1,3}(?:\.\d{3})*(?:,\d{2})?"
DATE = r"\b\d{2}/\d{2}/\d{4}\b|\b\d{4}-\d{2}-\d{2}\b"


def normalize_cnpj(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def is_valid_cnpj(text: Column) -> Column:
    """True for exactly 14 digits; check digits are not verified."""
    return F.length(normalize_cnpj(text)) == 14


def format_cnpj(text: Column) -> Column:
    """``00.000.000/0000-00``, null unless there are 14 digits."""
    digits = normalize_cnpj(text)
    dotted = F.regexp_replace(digits, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5")
    return F.when(F.length(digits) == 14, dotted)


def trigrams(text: Column) -> Column:
    """Distinct trigrams of each word, the word padded with two blanks in front and one behind."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded,
        lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))),
    )
    return F.array_distinct(F.flatten(grams))


def text_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams, in [0, 1]."""
    ta, tb = trigrams(a), trigrams(b)
    union = F.size(F.array_union(ta, tb))
    return F.when(a.isNull() | b.isNull(), None).otherwise(
        F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(ta, tb)) / union)
    )


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def extract_entities(text: Column) -> dict[str, Column]:
    """Money amounts, dates and company ids mentioned in a text."""
    return {
        "valores": F.regexp_extract_all(text, F.lit(MONEY), F.lit(0)),
        "datas": F.regexp_extract_all(text, F.lit(DATE), F.lit(0)),
        "cnpjs": F.transform(F.regexp_extract_all(text, F.lit(COMPANY_ID), F.lit(0)), normalize_cnpj),
    }
