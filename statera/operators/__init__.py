"""DataFrame operators: every one takes its column names as parameters."""

from statera.operators.audit import (
    AuditRule,
    audit_in_one_pass,
    foreign_key_audit,
    not_null_audit,
    orphans,
    unique_audit,
)
from statera.operators.latest import keep_first, latest_coalesced, latest_per_entity
from statera.operators.lookup import band_lookup, label_lookup, lookup_with_default
from statera.operators.measures import (
    measure_sums,
    measures,
    measures_of,
    newer_rows,
    price_statistics,
    replaced_sums,
)
from statera.operators.nesting import nest_children
from statera.operators.paging import ordered, ordered_terms, page, page_by_position, page_by_ranges
from statera.operators.position import dimension_key, ordered_position, surrogate_key
from statera.operators.projection import keep_existing, rename_all, rename_first, with_defaults
from statera.operators.quantiles import bounded_scores, exact_quantiles
from statera.operators.search import search
from statera.operators.sets import add_missing_entities, distinct_values, first_seen
from statera.operators.textrows import split_to_rows
from statera.operators.upsert import insert_if_absent, upsert

__all__ = [
    "AuditRule",
    "add_missing_entities",
    "audit_in_one_pass",
    "band_lookup",
    "bounded_scores",
    "dimension_key",
    "distinct_values",
    "exact_quantiles",
    "first_seen",
    "foreign_key_audit",
    "insert_if_absent",
    "keep_existing",
    "keep_first",
    "label_lookup",
    "latest_coalesced",
    "latest_per_entity",
    "lookup_with_default",
    "measure_sums",
    "measures",
    "measures_of",
    "nest_children",
    "newer_rows",
    "not_null_audit",
    "ordered",
    "ordered_position",
    "ordered_terms",
    "orphans",
    "page",
    "page_by_position",
    "page_by_ranges",
    "price_statistics",
    "rename_all",
    "rename_first",
    "replaced_sums",
    "search",
    "split_to_rows",
    "surrogate_key",
    "unique_audit",
    "upsert",
    "with_defaults",
]
