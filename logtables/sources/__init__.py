"""Scans: request logs, object manifests, backup catalogue, run ledger."""
