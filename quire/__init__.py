"""quire: inverted text indexes built, stored, merged and probed as Spark
DataFrame jobs.

Entry points: ``quire.plans.build`` (build / write / open / query an index),
``quire.operators`` (the individual operators), ``quire.sources`` and
``quire.sinks`` (file formats), ``quire.streaming`` (incremental runs).
"""

__version__ = "0.1.0"
