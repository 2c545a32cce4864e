"""tidemark: set-based record-readiness operators on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
column expressions, joins, aggregates and (where order matters) windows over
bounded groups. Nothing on the batch path runs Python per row.
"""

from tidemark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
