"""The operators applied to the test tables, each with its SQL twin."""

from workload import aggregates, combining, detections, scalars, selection, sources, stores, timeaxes  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
