"""Streaming: intentionally empty.

The reference has no streaming sources, watermarks, windows or state: every
load is a bounded batch started by hand, and late rows are handled only as
backfill by the gap-range planner (:mod:`tidemark.operators.coverage`).
"""
