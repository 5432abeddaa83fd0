"""Chart attributes of a sentiment label."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.numeric import one_decimal

# Colour per label, and the colour of every other label.
LABEL_COLORS = {"NEG": "red", "NEU": "gray", "POS": "green"}
OTHER_COLOR = "blue"


def label_color(label) -> Column:
    colors = F.create_map(*[F.lit(part) for pair in LABEL_COLORS.items() for part in pair])
    return F.coalesce(F.try_element_at(colors, _column(label)), F.lit(OTHER_COLOR))


def label_caption(label, percentage) -> Column:
    """``POS (41.7%)``"""
    return F.format_string("%s (%s%%)", _column(label), one_decimal(percentage))


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
