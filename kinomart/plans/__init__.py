"""Staging models, marts, reports, declared checks and the full build."""
