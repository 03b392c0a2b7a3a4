"""Operations of a training-data pipeline: deduplication, tokens, extraction, mixing, search."""
