"""tripwise: driver-engagement analytics on Spark.

Entry points: ``tripwise.plans.layers.Layers`` (wires the model for one input),
``tripwise.plans.catalog.QUERIES`` (one named result per operator),
``tripwise.plans.runner`` (production run, every layer stored) and
``tripwise.streaming`` (incremental loads).
"""

__version__ = "0.1.0"
