"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from lapsewise.functions.dates import (  # noqa: F401
    date_key,
    day_of_week_sunday0,
    day_name,
    is_month_end,
    is_month_start,
    month_name,
    parse_date,
)
from lapsewise.functions.numeric import half_up, idiv, ratio_half_up  # noqa: F401
from lapsewise.functions.text import (  # noqa: F401
    field_count,
    is_preamble_line,
    lpad_text,
    pad_key,
    py_strip,
    split_literal,
)
from lapsewise.functions.hashing import md5_hash, salted_sha256  # noqa: F401
