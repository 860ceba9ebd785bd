"""Reading the embedding markers a search answer carries in its provenance strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the markers
FAMILY = r"^embedding_runtime_family=(.+)$"
DIM = r"^embedding_runtime_dim=(\d+)$"
FUSION = "cross_dim_fusion="


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def marker_lines(provenance: Column) -> Column:
    """Stripped, non-blank strings."""
    lines = F.transform(F.coalesce(provenance, F.array().cast("array<string>")), lambda p: _stripped(F.coalesce(p, F.lit(""))))
    return F.filter(lines, lambda line: line != "")


def _last(lines: Column, pattern: str) -> Column:
    values = F.filter(F.transform(lines, lambda x: F.regexp_extract(x, pattern, 1)), lambda v: v != "")
    return F.try_element_at(values, F.lit(-1))


def runtime_info(provenance: Column) -> Column:
    """``struct(family, provider, dim, cross_dim_fusion, n_lines)``; a later marker overrides an earlier one."""
    lines = marker_lines(provenance)
    family = F.coalesce(_stripped(_last(lines, FAMILY)), F.lit(""))
    return F.struct(
        family.alias("family"),
        F.substring_index(family, ":", 1).alias("provider"),
        _last(lines, DIM).cast("int").alias("dim"),
        F.exists(lines, lambda line: line.startswith(FUSION)).alias("cross_dim_fusion"),
        F.size(lines).alias("n_lines"),
    )
