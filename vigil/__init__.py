"""vigil: condition-monitoring analytics on Spark.

Every operator is a DataFrame -> DataFrame function.  Operators that learn
state from data are split into ``fit_*`` (returns a small parameter object,
persisted as a one-row or k-row table) and ``apply_*`` / ``transform``
(pure column expressions), so scoring reuses training parameters.
"""

from vigil.session import get_session, work_dir  # noqa: F401

__all__ = ["get_session", "work_dir"]
