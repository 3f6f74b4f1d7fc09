"""Result normalisation at the edge of the library.

Inside the library money stays exact decimal; results handed to external
comparison are converted to double (one rounding of the exact value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decimals_to_double(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
