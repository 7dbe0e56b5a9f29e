"""Incremental (daily) processing.

``incremental`` holds what makes a one-day run produce the same tables as a full
reload: partition-scoped merges, latest-flag repair across days, and fact refresh for
touched partitions only. ``retraction`` follows withdrawn and reinstated parents to
their children. ``daily`` drives both from a landing folder with Structured Streaming.
"""
