"""Imports every query module, which fills the registry."""

from tapeloom.plans import queries_clean, queries_features, queries_gold, queries_input, queries_io, queries_quality, queries_reference  # noqa: F401
