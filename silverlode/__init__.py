"""silverlode: layered (bronze / silver / gold) analytics written as Spark jobs.

Sub-packages
------------
``sources``    readers for raw files, event streams and layer tables
``functions``  column expressions (text, money, time)
``operators``  rule tagging, de-duplication, merge, versioned tables, layout
``plans``      the bronze, silver and gold jobs built from the operators
``streaming``  event ingestion and watermarked window aggregates
"""

__version__ = "0.1.0"
