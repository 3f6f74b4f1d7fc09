"""Reusable DataFrame operators (DataFrame in, DataFrame out)."""

from lapsewise.operators.dedup import first_wins, last_wins  # noqa: F401
from lapsewise.operators.keys import dense_index  # noqa: F401
from lapsewise.operators.median import group_median, impute_group_median  # noqa: F401
