"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; the thin queries over the test tables live in :mod:`.queries`.
"""
