"""basketry: e-commerce event analytics as PySpark DataFrame transforms.

Every analysis is a pure ``DataFrame -> DataFrame`` function that runs the
same way over a batch table and over a streaming DataFrame; only the source,
watermark and sink differ.  See README.md for the layout.
"""

__version__ = "0.1.0"
