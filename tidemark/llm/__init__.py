"""Training-data operators: quality, dedup, tokens, language models, packing and mixing."""
