from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    """A column given by name or as an expression."""
    return F.col(c) if isinstance(c, str) else c


def free_prefix(names: list[str]) -> str:
    """Underscores with which none of the names begins: columns of our own cannot clash with a caller's."""
    prefix = "_"
    while any(name.startswith(prefix) for name in names):
        prefix += "_"
    return prefix
