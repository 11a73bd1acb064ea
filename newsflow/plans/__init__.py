"""Composite jobs as ``DataFrame -> DataFrame`` chains (JOB-1, JOB-2, JOB-4, JOB-5, ingest)."""
