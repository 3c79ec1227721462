from tallywing.sinks.bucketed import BucketedTable
from tallywing.sinks.keyed import TABLES, KeyedTable, merge
from tallywing.sinks.state import STATES, RatioState
from tallywing.sinks.tsv import tsv_lines, write_tsv

__all__ = ["STATES", "TABLES", "BucketedTable", "KeyedTable", "RatioState", "merge", "tsv_lines", "write_tsv"]
