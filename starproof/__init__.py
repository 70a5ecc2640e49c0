"""Star-schema analytics with proof, written as Spark DataFrame programs.

Sub-packages:

* ``functions``  column expressions (parsing, measures, display text)
* ``sources``    scans, landing formats and file fingerprints
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      whole pipelines: ingestion, checks, views, publication
"""
