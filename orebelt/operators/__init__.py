from orebelt.operators.aggregate import row_count, summary_stats, yearly_sums
from orebelt.operators.joins import (
    broadcast_if_small,
    enrich_by_year,
    measured_bytes,
    name_difference,
    one_row_per_key,
    orphans,
)
from orebelt.operators.mirror import extract_links, mirror, sync_stats
from orebelt.operators.payload import (
    envelope_schema,
    pack_records,
    parse_payload,
    payload_keys,
    wrap_envelope,
)
from orebelt.operators.quality import (
    append_audit,
    dq_report,
    expect_or_drop,
    observe_rules,
    observed_report,
    read_audit,
)
from orebelt.operators.ranking import (
    arg_max_per_group,
    latest_per_key,
    sort_rows,
    top_n,
    with_group_max,
)
from orebelt.operators.snapshot import latest_name, latest_snapshot

__all__ = [
    "append_audit",
    "arg_max_per_group",
    "broadcast_if_small",
    "dq_report",
    "enrich_by_year",
    "envelope_schema",
    "expect_or_drop",
    "extract_links",
    "latest_name",
    "latest_per_key",
    "latest_snapshot",
    "measured_bytes",
    "mirror",
    "name_difference",
    "observe_rules",
    "observed_report",
    "one_row_per_key",
    "orphans",
    "pack_records",
    "parse_payload",
    "payload_keys",
    "read_audit",
    "row_count",
    "sort_rows",
    "summary_stats",
    "sync_stats",
    "top_n",
    "with_group_max",
    "wrap_envelope",
    "yearly_sums",
]
