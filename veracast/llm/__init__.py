"""Operations of a training-data pipeline: tokenizing, deduplication, extraction, filtering."""
