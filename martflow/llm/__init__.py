"""Training-data operators: quality, near duplicates, page text, mixing,
toxicity, nearest neighbours, secrets, piece codec, URL rules, language,
ranked search, Merkle manifest, fingerprints.

Nothing else in the library imports this subpackage.
"""
