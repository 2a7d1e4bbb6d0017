"""docindex: a PySpark-native document-index engine.

Documents live in Spark tables (``doc_table``), writes arrive as an ordered
ops log (``ops_log``), and every read, write, analysis and schema operation is
a DataFrame composition that Catalyst plans and executors run.
"""

from docindex.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
