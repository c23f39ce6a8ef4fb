"""repsmith: a PySpark-native analytics engine for nested, versioned activity logs.

Every public function is either ``Column -> Column`` (``repsmith.functions``) or
``DataFrame -> DataFrame`` (``repsmith.operators``), so Catalyst sees through all of
it: no row-at-a-time Python UDF sits on a hot path.
"""

from repsmith.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
