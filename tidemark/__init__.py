"""Release-state and license analytics as Spark jobs.

``functions``  column expressions (versions, URLs, license expressions, cursors)
``sources``    landed JSON documents and stored tables as DataFrames
``operators``  DataFrame -> DataFrame transforms (change capture, merge, verdicts, checks)
``plans``      whole incremental jobs built from the operators
``streaming``  the catalog job as a Structured Streaming query
"""
