"""fmspark: factorization-machine feature engineering as Spark DataFrame jobs.

Sub-packages
------------
sources    readers: partitioned tables, libsvm text, CSV, latent tables
sinks      writers: tables, libsvm / FM text, CSV, parquet
functions  column expressions over sparse rows (parse, format, filter)
operators  row reshaping, feature transforms, index map and split,
           FM / FFM scoring, metrics and training, embedding
plans      fixtures derived from the test tables, end-to-end pipelines,
           the registered queries and their SQL oracles
streaming  the stateless embedding as a Structured Streaming query
"""

__version__ = "0.1.0"
