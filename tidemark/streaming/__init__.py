"""Incremental jobs: event states, message ingest, outbox publishing."""
