"""Readers: raw JSONL lines into Bronze, Silver CSV, Gold in any of three formats."""

from strata.sources.files import read_gold, read_silver_csv  # noqa: F401
from strata.sources.jsonl import bronze, quarantine, read_lines  # noqa: F401
