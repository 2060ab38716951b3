"""Comment analytics as plain Spark DataFrame transforms.

Sub-packages: ``functions`` (column expressions), ``sources`` and ``sinks``
(readers and writers), ``operators`` (DataFrame -> DataFrame), ``plans``
(reports and staged runs), ``streaming`` (the same transforms on a stream).
"""

__version__ = "0.1.0"
