"""Operators over DataFrames: pages to elements, elements to records, records to the product table."""
