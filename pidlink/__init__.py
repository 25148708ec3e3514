"""pidlink: link two bibliographic catalogues through shared persistent identifiers, on Spark.

Sub-packages:

* ``sources``   -- readers (CSV dumps, zipped CSV, gz JSON lines, nested zip) and sinks
* ``functions`` -- column expressions and fixed values
* ``operators`` -- DataFrame -> DataFrame operators (extraction, PID index, mapping,
  flattening, categorisation, provenance, statistics)
* ``plans``     -- whole jobs composed from operators, and the driver's registered queries
* ``streaming`` -- incremental mapping of newly arriving Meta files
"""

__version__ = "0.1.0"
