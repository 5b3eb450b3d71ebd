"""Training-data operators: quality, URL filters, line dedup, HTML extraction, BPE, language ID, toxicity,
decontamination, fingerprints and near-dedup. Nothing outside this subpackage imports it."""
