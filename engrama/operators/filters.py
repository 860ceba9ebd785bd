"""Query scoping: every filter is a column predicate, so it reaches the table scan.

``QueryRequest`` holds the request fields; ``scoped`` applies exactly those that
are set.  Constraints on other tables are left semi joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.defaults import BROADCAST_BYTES, DEFAULT_TOP_K, DEFAULT_WINDOW_FROM, DEFAULT_WINDOW_TO
from engrama.session import join_null_safe, materialize

ID_BYTES = 128  # room for one id in memory


@dataclass(frozen=True)
class QueryRequest:
    """What a caller may ask for; empty fields do not filter."""

    workspace_id: str = ""
    tenant_id: str = ""
    session_id: str = ""
    agent_id: str = ""
    window_from: str = DEFAULT_WINDOW_FROM
    window_to: str = DEFAULT_WINDOW_TO
    dataset_name: str = ""
    import_batch_id: str = ""
    source_file_name: str = ""
    latest_batch_only: bool = False
    include_cold: bool = True
    include_payload: bool = True
    filter_expr: str = ""
    top_k: int = DEFAULT_TOP_K
    relation_constraints: Sequence[Mapping[str, str]] = field(default_factory=tuple)
    filters: Mapping[str, str] = field(default_factory=dict)


def scope(request: QueryRequest) -> list[Column]:
    """Equality on the scoping keys that are set."""
    wanted = {
        "tenant_id": request.tenant_id,
        "workspace_id": request.workspace_id,
        "session_id": request.session_id,
        "agent_id": request.agent_id,
        "dataset_name": request.dataset_name,
        "import_batch_id": request.import_batch_id,
        "source_file_name": request.source_file_name,
        **request.filters,
    }
    return [F.col(name) == F.lit(value) for name, value in wanted.items() if value]


def in_window(request: QueryRequest, column: str = "event_time") -> Column:
    """Both ends included."""
    start = F.lit(request.window_from).cast("timestamp_ntz")
    end = F.lit(request.window_to).cast("timestamp_ntz")
    return F.col(column).between(start, end)


def tier_allowed(include_cold: bool) -> Column:
    return F.lit(True) if include_cold else F.col("tier") == "hot"


def latest_batches(df: DataFrame, keys: Sequence[str] = ("workspace_id", "dataset_name")) -> DataFrame:
    """Rows of the newest import batch of each dataset: a partial-aggregated max, then a semi join."""
    newest = df.groupBy(*keys).agg(
        F.max(F.struct("event_time", "import_batch_id"))["import_batch_id"].alias("import_batch_id")
    )
    return join_null_safe(df, newest, [*keys, "import_batch_id"], "left_semi")


def related(df: DataFrame, edges: DataFrame, constraints: Sequence[Mapping[str, str]], id_column: str) -> DataFrame:
    """Objects with a matching outgoing edge for every constraint ``{edge_type, dst_id?}``."""
    for constraint in constraints:
        wanted = edges.where(F.col("edge_type") == constraint["edge_type"])
        if constraint.get("dst_id"):
            wanted = wanted.where(F.col("dst_id") == constraint["dst_id"])
        df = df.join(wanted.select(F.col("src_id").alias(id_column)), id_column, "left_semi")
    return df


def scoped(df: DataFrame, request: QueryRequest, edges: DataFrame | None = None, id_column: str = "memory_id") -> DataFrame:
    """All filters of a request; ones on columns the table lacks fail at analysis."""
    for predicate in scope(request):
        df = df.where(predicate)
    if "event_time" in df.columns:
        df = df.where(in_window(request))
    if not request.include_cold:
        df = df.where(tier_allowed(False))
    if request.filter_expr:
        df = df.where(request.filter_expr)
    if request.latest_batch_only:
        df = latest_batches(df)
    if request.relation_constraints:
        df = related(df, edges, request.relation_constraints, id_column)
    return df


def session_for(workspace: Column, dataset: Column, file_name: Column, session: Column) -> Column:
    """An explicit session; else the one bulk loading used for dataset and file; else the workspace's."""
    given = F.trim(session)
    name = F.trim(dataset)
    file_part = F.coalesce(file_name, F.lit(""))
    return (
        F.when(F.coalesce(given, F.lit("")) != "", given)
        .when(
            (F.coalesce(name, F.lit("")) != "") & (file_part != ""),
            F.concat(F.lit("ingest_"), name, F.lit("_"), file_part),
        )
        .otherwise(F.concat(F.lit("query_"), workspace))
    )


def with_payload(hits: DataFrame, payload: DataFrame, on: str, include_payload: bool) -> DataFrame:
    """Hits with their content when asked for; a hit without stored content stays, with nulls.

    The ids of the hits, if few enough, are sent to the scan of the content, so that
    only content of hits is shuffled.
    """
    if not include_payload:
        return hits
    pinned = materialize(hits)
    return pinned.join(only_of(payload, pinned, on), on, "left")


def only_of(rows: DataFrame, hits: DataFrame, on: str) -> DataFrame:
    """Rows whose id is among the hits': filtered where they are read as long as the ids may be broadcast."""
    ids = materialize(hits.select(on).distinct())
    small = ids.count() * ID_BYTES <= BROADCAST_BYTES
    return rows.join(F.broadcast(ids) if small else ids, on, "left_semi")


def listed(df: DataFrame, params: Mapping[str, str], limit: int | None, order: str) -> DataFrame:
    """List endpoint: equality parameters, then the first ``limit`` rows by id."""
    for name, value in params.items():
        df = df.where(F.col(name) == F.lit(value))
    return df.orderBy(order).limit(limit) if limit else df


def output_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(*fields)


def result_counts(df: DataFrame, keys: Sequence[str], id_column: str, exact: bool = True) -> DataFrame:
    distinct = F.count_distinct(id_column) if exact else F.approx_count_distinct(id_column, 0.05)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_objects"), distinct.alias("n_distinct"))
