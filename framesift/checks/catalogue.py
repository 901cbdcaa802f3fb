"""Importing this module registers every query."""

from framesift.checks import (  # noqa: F401
    buckets,
    captions,
    clips,
    evaluation,
    filters,
    jobs,
    joins,
    nested,
    ordering,
    paths,
    profiles,
    prompts,
    scores,
    sources,
)
from framesift.checks.registry import ORACLES, QUERIES  # noqa: F401
