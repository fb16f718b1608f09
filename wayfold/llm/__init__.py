"""Operators for building training data: quality, language, archives, near-copies, decontamination, toxicity, packing, secrets."""
