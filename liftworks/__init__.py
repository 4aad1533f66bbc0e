"""Risk-model analytics as Spark DataFrame operators.

Layers, lowest first:

* ``functions`` - column expressions (rounding, clipping, level maps)
* ``sources``   - scans, sinks and the staging area for reused intermediates
* ``operators`` - DataFrame to DataFrame operators
* ``plans``     - experiment configuration, the staged pipeline, and the query registry
"""
