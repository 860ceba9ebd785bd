"""Collections and segments: index settings, segment tables, catalog statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.defaults import DEFAULT_INDEX_TYPE, INDEX_TYPES
from engrama.functions.text import blank_to
from engrama.sources.snapshots import spread_by

IVF_SETTINGS = ("ivf_nlist", "ivf_nprobe", "ivf_m", "ivf_nbits")


def index_type_of(given: Column) -> Column:
    """Trimmed, upper-cased index name; the default when empty, null when unknown."""
    name = F.upper(blank_to(given, F.lit(DEFAULT_INDEX_TYPE)))
    return F.when(name.isin(*INDEX_TYPES), name)


def index_settings(catalog: DataFrame) -> DataFrame:
    """Add ``index_name``, ``index_error`` and ``index_fields``, the settings that are actually set.

    The type is among the fields when it was given or when any tuning value is.
    """
    known = index_type_of(F.col("index_type"))
    quantizer = F.trim(F.coalesce("ivf_sq_type", F.lit("")))
    tuned = F.lit(False)
    fields = F.array().cast("array<string>")
    for name in IVF_SETTINGS:
        is_set = F.coalesce(F.col(name), F.lit(0)) != 0
        tuned = tuned | is_set
        fields = F.concat(fields, F.when(is_set, F.array(F.concat(F.lit(f"{name}="), F.col(name)))).otherwise(F.array()))
    given = F.trim(F.coalesce("index_type", F.lit(""))) != ""
    kind = F.when(given | tuned | (quantizer != ""), F.array(F.concat(F.lit("index_type="), known))).otherwise(F.array())
    sq = F.when(quantizer != "", F.array(F.concat(F.lit("ivf_sq_type="), quantizer))).otherwise(F.array())
    return catalog.withColumns({
        "index_name": known,
        "index_error": known.isNull(),
        "index_fields": F.when(known.isNotNull(), F.array_join(F.concat(kind, fields, sq), ",")),
    })


def known_index_type(given: str | None) -> str:
    """The index a caller means; an empty choice is the default."""
    wanted = given.strip().upper() if given and given.strip() else DEFAULT_INDEX_TYPE
    if wanted in INDEX_TYPES:
        return wanted
    raise ValueError(f"no such index: {given!r}; known are {' '.join(sorted(INDEX_TYPES))}")


def segment_table(
    rows: DataFrame, index_type: str | None = None, ivf_nlist: int = 0, ivf_nprobe: int = 0, ivf_m: int = 0,
    ivf_nbits: int = 0, ivf_sq_type: str = "", write_to: str | None = None,
) -> DataFrame:
    """Vectors as float32 rows of their segment, with the index choice; written one folder per segment."""
    name = known_index_type(index_type)
    table = rows.select(
        "segment_id", "object_id", F.col("embedding").cast("array<float>").alias("embedding"),
        F.lit(name).alias("index_type"), F.lit(ivf_nlist).alias("ivf_nlist"), F.lit(ivf_nprobe).alias("ivf_nprobe"),
        F.lit(ivf_m).alias("ivf_m"), F.lit(ivf_nbits).alias("ivf_nbits"), F.lit(ivf_sq_type).alias("ivf_sq_type"),
    )
    if write_to:
        spread_by(table, "segment_id").write.partitionBy("segment_id").mode("append").parquet(write_to)
    return table


def collection_stats(catalog: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every collection with its vector count and whether stored dimensions match the declared one."""
    stored = vectors.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.min(F.size("embedding")).alias("min_dim"), F.max(F.size("embedding")).alias("max_dim"),
    )
    fits = (F.col("dimension") > 0) & F.coalesce(
        (F.col("min_dim") == F.col("dimension")) & (F.col("max_dim") == F.col("dimension")), F.lit(True)
    )
    return catalog.join(stored, "segment_id", "left").withColumns(
        {"n_vectors": F.coalesce("n_vectors", F.lit(0)), "dimension_ok": fits}
    ).drop("min_dim", "max_dim").orderBy("collection_name")


def dimension_check(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Per segment: the dimensions found and whether all equal the query dimension."""
    found = rows.groupBy("segment_id").agg(
        F.min(F.size("embedding")).alias("min_dim"), F.max(F.size("embedding")).alias("max_dim")
    )
    return found.join(expected, "segment_id").withColumn(
        "matches", (F.col("min_dim") == F.col("query_dim")) & (F.col("max_dim") == F.col("query_dim"))
    )
