"""The core library's query catalogue."""

from inkmill.plans import q_boxes, q_files, q_parts, q_pixels, q_shapes, q_stats, q_text  # noqa: F401
from inkmill.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
