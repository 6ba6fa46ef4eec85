"""Imports every query module so the registry is complete."""

from cadence.plans import q_content, q_genre, q_ingest, q_itemcf, q_next, q_profile, q_quality, q_sequences  # noqa: F401
from cadence.plans.registry import ORACLES, QUERIES  # noqa: F401

q_next._register_comparison()
