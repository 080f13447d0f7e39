"""recurwork — repeat maintenance-work analytics as lazy Spark DataFrame operators.

Every public operator is a function ``(DataFrame(s), parameters) -> DataFrame``.
Nothing is collected to the driver; no Python UDF is used.  See README.md.
"""

from recurwork.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
