from tallymark.operators.aggregates import (
    avg_by_lookup,
    avg_by_multivalue,
    avg_count_by,
    best_with_min_support,
    bucketed_avg_wide,
    conditional_avg,
    count_by,
    distinct_totals,
    merge_means,
    sums_by,
)
from tallymark.operators.commerce import (
    in_year,
    pair_stats,
    revenue_by,
    revenue_by_lookup,
    valid_scores,
)
from tallymark.operators.distinct import distinct_by, numbered_values
from tallymark.operators.joins import attach_title, lookup, one_per_key
from tallymark.operators.layout import (
    colocated_join,
    read_clustered,
    write_clustered,
    write_colocated,
)
from tallymark.operators.membership import drop_members, membership_filter
from tallymark.operators.places import with_places
from tallymark.operators.rows import fresh_rows, pinned
from tallymark.operators.skew import frequent_keys, isolating_join
from tallymark.operators.tokens import drop_stopwords, tokenize
from tallymark.operators.rollups import read_means, update_means
from tallymark.operators.topk import most_frequent, top_n, top_n_per_group

__all__ = [
    "attach_title",
    "avg_by_lookup",
    "avg_by_multivalue",
    "avg_count_by",
    "best_with_min_support",
    "bucketed_avg_wide",
    "colocated_join",
    "conditional_avg",
    "count_by",
    "distinct_by",
    "distinct_totals",
    "drop_members",
    "drop_stopwords",
    "frequent_keys",
    "fresh_rows",
    "in_year",
    "isolating_join",
    "lookup",
    "membership_filter",
    "most_frequent",
    "merge_means",
    "numbered_values",
    "one_per_key",
    "pair_stats",
    "pinned",
    "read_clustered",
    "read_means",
    "revenue_by",
    "revenue_by_lookup",
    "sums_by",
    "tokenize",
    "top_n",
    "top_n_per_group",
    "update_means",
    "valid_scores",
    "with_places",
    "write_clustered",
    "write_colocated",
]
