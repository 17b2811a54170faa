"""End-to-end queries over the driver tables and their SQL oracles."""
