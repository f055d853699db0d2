"""Training-data operators: cleaning, deduplication, tokenizing, scoring and packing of documents."""
