from shipcast.functions.columns import (  # noqa: F401
    clip,
    datetime_columns,
    flag,
    nan_to_null,
    numeric_columns,
    pct_round2,
    present,
    rnd,
    string_columns,
)
