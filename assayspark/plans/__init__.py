"""Registered queries, grouped by area; importing this package fills the registry."""

from assayspark.plans import registry
from assayspark.plans import (  # noqa: F401
    extra_q,
    models_q,
    profile_q,
    sampling_q,
    scoring_q,
    sequence_q,
    signal_q,
    sources_q,
    tidy_q,
    tokens_q,
)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
