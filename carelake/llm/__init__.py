"""Training-data operators (deduplication, tokenising, quality, mixing, search, language, personal data).

Nothing else in the library imports this subpackage.  Operators take a DataFrame with the columns of
``documents`` (or ``embeddings``), read only the columns they name, and return new columns under their
own names, so extra columns of any name never clash.
"""
