"""Importing this package fills the registry."""

from shedlake.plans.queries import dimension, gold, ingest, lake, scalar, serving, silver, snapshots

__all__ = ["dimension", "gold", "ingest", "lake", "scalar", "serving", "silver", "snapshots"]
