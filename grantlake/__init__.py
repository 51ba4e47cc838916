"""Governance-feed analytics on Spark: change events in, state and history tables out."""

from grantlake.entities import AUDIT, ENTITIES, Entity, entity

__all__ = ["AUDIT", "ENTITIES", "Entity", "entity"]
