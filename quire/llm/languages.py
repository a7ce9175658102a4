"""Codes of languages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANGUAGES = ("ru", "en", "uk", "de", "fr")
#: Spellings of each code. Fixed values.
SPELLINGS = {
    "ru": ("ru", "rus", "russian", "русский", "російська"),
    "en": ("en", "eng", "english", "английский", "англійська"),
    "uk": ("uk", "ukr", "ukrainian", "ua", "украинский", "українська"),
    "de": ("de", "deu", "ger", "german", "deutsch", "немецкий", "німецька"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais", "французский", "французька"),
    "mixed": ("mixed", "multi", "mul", "multiple", "multilingual"),
}


def code_of(given: Column) -> Column:
    """The code of a language however it is spelled; null if it is missing or unknown."""
    base = F.regexp_extract(F.lower(F.trim(given)), r"^(\p{L}+)", 1)
    out = F.lit(None).cast("string")
    for code, names in SPELLINGS.items():
        out = F.when(base.isin(*names), F.lit(code)).otherwise(out)
    return out
