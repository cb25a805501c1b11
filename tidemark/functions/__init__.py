"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tidemark.functions.dates import (  # noqa: F401
    date_to_int,
    date_to_text,
    lenient_date,
    lenient_timestamp,
    to_calendar_date,
)
from tidemark.functions.numeric import (  # noqa: F401
    midpoint,
    nan_to_null,
    safe_ratio,
    scale,
    spread,
    to_double,
)
from tidemark.functions.text import (  # noqa: F401
    ends_with_any,
    header_key,
    regex_group,
)
from tidemark.functions.quotes import asset_class_of, instrument_type_of  # noqa: F401
