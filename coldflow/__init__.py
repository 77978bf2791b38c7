"""coldflow: a PySpark-native engine for cold-start recall data work.

Batch and streaming jobs over DataFrames: log-line parsing with reject
tables, full-text match joins against a catalogue, capped per-user recall
lists, versioned keyed tables (sorted sets, hashes, strings, cells), two-hop
interest-graph jobs, news title search and per-channel top-k.
"""

__all__ = ["session"]
