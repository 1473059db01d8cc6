"""Readers: text of requests, snapshots and stored state into typed rows."""
