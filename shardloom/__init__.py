"""shardloom: text-corpus preparation expressed as Spark DataFrame jobs.

Sub-packages:
  functions  - column expressions (cleaning rules, hashing, pre-tokenization)
  sources    - scans and sinks (registry ingest, line shards, ledger JSON, token binaries)
  operators  - set-based operators (sharding, dedup, ledger, integrity, BPE, packing, metrics)
  plans      - stage composition (stage board, gates, end-to-end batch plan, derived fixtures)
  streaming  - incremental (Structured Streaming) variants
"""

__version__ = "0.1.0"
