"""The named data products, layer by layer."""
