"""Training-data operators: encoding, filtering, deduplication and packing of documents."""
