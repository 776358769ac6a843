"""strandline: landing files into tables and keeping them correct, on Spark.

Every transform is a DataFrame -> DataFrame function (or a Column builder)
so the same code serves batch reads, streaming micro-batches and repairs.
"""

from strandline.contracts import REGISTRY, TableContract

__all__ = ["REGISTRY", "TableContract"]
