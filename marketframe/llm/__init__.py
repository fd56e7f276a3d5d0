"""Training-data operators: packing, token files, filters, near-duplicates, decontamination."""
