"""Writers for the Silver and Gold layers and the size of what they wrote."""

from strata.sinks.writers import output_sizes, write_gold, write_table  # noqa: F401
