"""Scans: driver parquet tables, landed JSON envelopes, manifests, seeds."""
