from silverlode.operators.dedupe import newest_per_key, rank_within_key, split_duplicates
from silverlode.operators.merge import merge_by_key
from silverlode.operators.partitioned import PartitionedTable
from silverlode.operators.rules import (
    ForeignKey, NotNull, Parses, Range, Ruleset, Unique,
    split_foreign_key, split_nulls, split_range,
)
from silverlode.operators.versioned import VersionedTable

__all__ = [
    "ForeignKey", "NotNull", "Parses", "PartitionedTable", "Range", "Ruleset", "Unique", "VersionedTable",
    "merge_by_key", "newest_per_key", "rank_within_key", "split_duplicates",
    "split_foreign_key", "split_nulls", "split_range",
]
