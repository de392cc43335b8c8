from weir.operators.aggregates import aggregate
from weir.operators.grouping import cube_sets, grouping_sets, rollup_sets
from weir.operators.joins import broadcast_if_small, join_frames, join_using, planned_bytes
from weir.operators.layout import cache, coalesce, rebalance, repartition, repartition_by, uncache
from weir.operators.quality import (
    Check,
    ValidationFailed,
    drop_invalid,
    null_checks,
    orphans,
    quarantine,
    split_references,
    range_checks,
    rule_checks,
    validate_nulls,
    validate_ranges,
    validate_references,
    validate_rules,
    violation_report,
    violation_samples,
    with_violations,
)
from weir.operators.ranges import range_join
from weir.operators.reshape import pivot, unpivot
from weir.operators.sampling import sample_per
from weir.operators.scans import filled_forward, ranked, running, shifted
from weir.operators.schemas import (
    SchemaMismatch,
    avro_schema_json,
    compatible,
    evolve,
    schema_compat,
    schema_profile,
    split_by_schema,
    to_avro_schema,
    validate_schema,
)
from weir.operators.sets import intersect, subtract, union_frames
from weir.operators.sketches import merged, read_store, sketched, update_sketches
from weir.operators.snapshots import high_water_mark, newer_than, snapshot_as_of
from weir.operators.transforms import enrich, filter_rows
from weir.operators.versions import as_of_join, validity_intervals

__all__ = [
    "Check",
    "SchemaMismatch",
    "ValidationFailed",
    "aggregate",
    "as_of_join",
    "avro_schema_json",
    "broadcast_if_small",
    "cache",
    "coalesce",
    "compatible",
    "cube_sets",
    "drop_invalid",
    "enrich",
    "evolve",
    "filled_forward",
    "filter_rows",
    "grouping_sets",
    "high_water_mark",
    "intersect",
    "join_frames",
    "join_using",
    "merged",
    "newer_than",
    "null_checks",
    "orphans",
    "pivot",
    "planned_bytes",
    "quarantine",
    "range_checks",
    "range_join",
    "ranked",
    "read_store",
    "rebalance",
    "repartition",
    "repartition_by",
    "rollup_sets",
    "rule_checks",
    "running",
    "sample_per",
    "schema_compat",
    "schema_profile",
    "shifted",
    "sketched",
    "snapshot_as_of",
    "split_by_schema",
    "split_references",
    "subtract",
    "to_avro_schema",
    "uncache",
    "union_frames",
    "unpivot",
    "update_sketches",
    "validate_nulls",
    "validate_ranges",
    "validate_references",
    "validate_rules",
    "validate_schema",
    "validity_intervals",
    "violation_report",
    "violation_samples",
    "with_violations",
]
