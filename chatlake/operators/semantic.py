"""The semantic view: display names over the curated table, hidden columns left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.schema import DISPLAY_NAMES


def semantic_view(
    curated: DataFrame,
    names: dict[str, str | None] = DISPLAY_NAMES,
    include_hidden: bool = False,
    view_name: str | None = None,
) -> DataFrame:
    """Rename columns for reporting, in the mapping's order.

    Columns mapped to None are hidden: left out, or kept under their own name
    with ``include_hidden=True``. ``view_name`` also registers a temp view.
    """
    cols = []
    for src, display in names.items():
        if display is not None:
            cols.append(F.col(src).alias(display))
        elif include_hidden:
            cols.append(F.col(src))
    view = curated.select(*cols)
    if view_name:
        view.createOrReplaceTempView(view_name)
    return view
