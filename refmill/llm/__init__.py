"""Operators that prepare training text: classify, tokenise, filter, pack, audit, search, deduplicate."""
