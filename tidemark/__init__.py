"""tidemark: loading and historising warehouse tables on Spark.

File landing, variant flattening, surrogate keys, type-2 and bitemporal merges,
each a function from DataFrames to DataFrames.
"""

from .functions.nulls import canonical, columntype_default, default_eq, null_default, null_default_join
from .functions.periods import BUS_OPEN_FROM, SYS_OPEN_END, ts_lit
from .functions.tokens import explode_tokens
from .operators.apply import apply_versions, merge_summary, split_applied, write_merged, write_split
from .operators.audit import audit, audit_frame, audit_run
from .operators.buckets import create_buckets, merge_buckets, read_buckets
from .operators.keygen import assign_keys, dense_number, hub_duplicates, keygen, keygen_summary, lookup_keys
from .operators.periods import check_overlaps, containing, envelope_versions, normalise_periods, period_envelope, period_neighbours, resolve_overlapping, split_overlapping
from .operators.roles import Roles, RoleError, resolve_roles, schema_diff, schema_diff_tables
from .operators.scd2 import scd2_merge, scd2_merge_set, source_duplicates
from .operators.temporal import OverlapError, plan_temporal, temporal_merge, temporal_merge_set
from .sources.landing import create_landing, land_batch, land_files, read_landing, write_table
from .sources.variant import discover_paths, flatten, persist_view, publish_view, save_paths, saved_paths
from .streaming.landing import SchemaDrift, land_stream, land_stream_checked, merge_each_batch, schema_log

__all__ = [n for n in dir() if not n.startswith("_")]
