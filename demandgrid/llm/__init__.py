"""Operators for large training-data pipelines (text quality, deduplication,
packing, language models, tokenizers). Nothing else in the package imports
this subpackage."""
