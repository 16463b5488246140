"""Imports every module of queries, so that the registry is full."""

from tessera.plans import q_gates, q_layout, q_lines, q_match, q_more, q_order, q_publish, q_scan, q_sets, q_text
from tessera.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "q_gates", "q_layout", "q_lines", "q_match", "q_more", "q_order", "q_publish", "q_scan", "q_sets", "q_text"]
