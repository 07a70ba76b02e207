"""Column functions: cleaning, phonetic keys, comparators."""
