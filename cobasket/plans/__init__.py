"""Multi-step batch jobs: incremental ingest, exports."""
