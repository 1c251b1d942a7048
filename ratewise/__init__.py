"""ratewise: rating cleaning, collaborative filtering and recommendation
serving expressed as Spark DataFrame / MLlib / Structured Streaming jobs.

Every public function takes and returns DataFrames; nothing is collected
to the driver except scalars whose size does not grow with the data
(row counts, partition offsets, a handful of metric rows).
"""

__version__ = "0.1.0"
