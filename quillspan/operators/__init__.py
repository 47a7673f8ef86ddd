"""Operators over collections of documents held in DataFrames."""
