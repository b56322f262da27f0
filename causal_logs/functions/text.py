"""Message text to search tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = r"[^\p{L}\p{N}]+"


def tokens(text) -> Column:
    """Lower-case runs of letters and digits, over the whole text.

    Text that starts or ends with a separator also gives an empty token there.
    """
    return F.split(F.lower(text), SEPARATORS)
