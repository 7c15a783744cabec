"""Column-expression helpers (scalar functions with R null semantics)."""

from . import clean, logic, text  # noqa: F401
from ._col import as_col  # noqa: F401
