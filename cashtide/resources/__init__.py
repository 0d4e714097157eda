"""Fixed vocabularies and the default sentiment lexicon."""
