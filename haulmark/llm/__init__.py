"""Operators that turn raw text tables into training data: cleaning, deduplication, tokens, archives.

Every operator takes a DataFrame and the names of its id and text columns, ignores all other columns, and works on whole
texts.  Rows without an id are never matched with others: filters keep them as they are.
"""
