"""Training-data operators: filtering, deduplication, extraction, scoring, mixing and token output."""
