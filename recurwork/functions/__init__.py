"""Column-expression helpers (predicates, defaults, scalars, derived measures)."""

from recurwork.functions.exprs import *  # noqa: F401,F403
from recurwork.functions.measures import *  # noqa: F401,F403
