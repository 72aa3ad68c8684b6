"""Word splitting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token separator, ASCII word characters only.
SEPARATOR = r"\W+"


def split_words(text: Column) -> Column:
    """Lower-cased parts of a line between separators; the first and last may be empty."""
    return F.split(F.lower(text), SEPARATOR)
