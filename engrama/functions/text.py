"""Text expressions: tokens, slugs, normal forms, sentence splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: id tokens keep only these characters; text tokens are letters and digits of all scripts
SLUG_DROP = r"[^A-Za-z0-9_-]+"
TOKEN_SPLIT = r"[^\p{L}\p{M}\p{N}]+"
SENTENCE_SPLIT = r"[.!?\n]+"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def slug(value: Column, fallback: str) -> Column:
    """Id-safe form of a name; ``fallback`` when nothing is left."""
    cleaned = F.btrim(F.regexp_replace(value, SLUG_DROP, "_"), F.lit("_"))
    return F.when(cleaned == "", fallback).otherwise(cleaned)


def blank_to(value: Column, fallback: Column) -> Column:
    """``fallback`` where the value is missing or only blanks."""
    trimmed = F.trim(value)
    return F.when(F.coalesce(trimmed, F.lit("")) == "", fallback).otherwise(trimmed)


def normal_form(text: Column) -> Column:
    """Case- and spacing-insensitive form for finding copies."""
    return F.regexp_replace(F.lower(F.trim(text)), r"[ \t\n]+", " ")


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, SENTENCE_SPLIT), lambda s: F.trim(s)), lambda s: s != "")
