"""Reading raw documents and reference data, and storing tables by layer."""
