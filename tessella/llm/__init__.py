"""Training-data operators: quality, deduplication, extraction, scoring and mixing of document tables.

Every operator takes and returns DataFrames. Texts are handled whole; a null text counts as an empty one.
An operator reads only the columns it names, so further columns, whatever they are called, never clash; where an
operator adds columns to its input, its own replace input columns of the same name.
"""
