"""lapsewise — a Spark-native lapse-warehouse pipeline.

Every step (ingest, text cleaning, star-schema loading, deduplication,
imputation, marts and data-quality checks) is a DataFrame transformation or
a Structured Streaming query, so it runs unchanged from ``local[8]`` to a
large cluster.

Most-used entry points are re-exported here::

    from lapsewise import build_session, first_wins, group_median, clean_files
"""

__version__ = "0.1.0"

from lapsewise.session import build_session, materialize, release_scratch  # noqa: E402,F401
from lapsewise.operators.dedup import first_wins, last_wins  # noqa: E402,F401
from lapsewise.operators.median import group_median, impute_group_median  # noqa: E402,F401
from lapsewise.operators.keys import dense_index  # noqa: E402,F401
from lapsewise.operators.loading import insert_if_absent, replace_table  # noqa: E402,F401
from lapsewise.operators.textclean import clean_files, file_profiles  # noqa: E402,F401
from lapsewise.operators import quality  # noqa: E402,F401
from lapsewise.plans import models, warehouse, incremental  # noqa: E402,F401
from lapsewise.streaming.ingest import ParquetToCsvIngest  # noqa: E402,F401
