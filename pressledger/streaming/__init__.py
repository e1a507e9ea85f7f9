"""The ledger operators over Structured Streaming sources."""
