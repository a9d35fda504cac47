"""Column functions: text analysis, stemming, hashing and small field helpers."""
