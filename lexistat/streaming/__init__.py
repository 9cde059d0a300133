"""Incremental landing of crawled pages."""
