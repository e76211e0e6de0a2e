from ferry.operators.batches import assign_batches
from ferry.operators.documents import (
    attach_bodies,
    attachment_manifest,
    attachment_parent_lookup,
    attachment_payload,
    eligible_contracts,
    latest_version_manifest,
    linked_to,
    name_collisions,
    transfer_summary,
    unreadable_dates,
)
from ferry.operators.enrich import ambiguous_lookup_keys, lookup_enrich
from ferry.operators.extract import (
    align_to_fields,
    exportable_fields,
    field_names,
    filtered_extract,
    metadata_from_schema,
)
from ferry.operators.identity import identity_match, identity_pairs
from ferry.operators.owners import owner_matched, owner_remap, owner_unmatched_summary
from ferry.operators.reconcile import (
    accumulate_crosswalk,
    ambiguous_targets,
    duplicate_ids,
    id_crosswalk,
    loaded_delta,
    orphan_records,
    outcome_by_batch,
    outcome_by_job,
    outcome_rows,
    run_reconciliation,
)
from ferry.operators.stamp import stamp_load_time

__all__ = [
    "accumulate_crosswalk", "align_to_fields", "ambiguous_lookup_keys", "ambiguous_targets", "attach_bodies", "assign_batches", "attachment_manifest",
    "attachment_parent_lookup", "attachment_payload", "duplicate_ids",
    "eligible_contracts", "exportable_fields", "field_names", "filtered_extract", "id_crosswalk",
    "identity_match", "identity_pairs", "latest_version_manifest", "linked_to", "loaded_delta",
    "lookup_enrich", "metadata_from_schema", "name_collisions", "orphan_records", "outcome_by_batch", "outcome_by_job",
    "outcome_rows", "owner_matched", "owner_remap", "owner_unmatched_summary",
    "run_reconciliation", "stamp_load_time", "transfer_summary", "unreadable_dates",
]
