"""Document-to-table processing on Spark DataFrames."""

from docpipe.spec import DocumentSpec, Field, Output, PartsTotal, Product, SumOf

__all__ = ["DocumentSpec", "Field", "Output", "PartsTotal", "Product", "SumOf"]
