"""Operations of a training-data pipeline: fingerprints, deduplication, sharding, scoring, mixing, encoding."""
