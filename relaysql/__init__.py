"""relaysql: config-driven SQL over JSON message streams, on PySpark.

A job is an input schema, optional functions, one SQL statement over the table
``source`` and an output schema. Messages are decoded into ``source``, the SQL
runs per micro-batch, and each result row is published as a JSON message.
"""

from relaysql.plans.job import BatchResult, SqlJob, preview
from relaysql.spec import JobSpec

__all__ = ["BatchResult", "JobSpec", "SqlJob", "preview"]
