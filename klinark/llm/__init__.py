"""Operations of a training-data pipeline: near duplicates, classifiers, shards, tokens, mixtures, searches."""
