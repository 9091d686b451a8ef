"""Targets that micro-batches write to, and the flows between them."""

from shedlake.streaming.flows import append_flow, upsert_flow
from shedlake.streaming.targets import AppendTarget, KeyedTarget, SnapshotTarget

__all__ = ["AppendTarget", "KeyedTarget", "SnapshotTarget", "append_flow", "upsert_flow"]
