"""Operations on text corpora for training data: cleaning, deduplication, scoring and packing."""
