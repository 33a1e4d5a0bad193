"""cargolens: a supply-chain warehouse and its decision queries as PySpark jobs.

Layers: raw text (bronze) -> typed and cleaned (silver) -> star schema (gold)
-> thirteen analyses.  Everything is DataFrame work; no Python runs per row.
"""

__version__ = "0.1.0"
