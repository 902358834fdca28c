"""Operators over DataFrames: crawling, HTML, cleaning, chunking, merging, questions."""
