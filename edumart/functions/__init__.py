from edumart.functions.scalar import (  # noqa: F401
    PANDAS_NA_TOKENS,
    exact_mean,
    fill_category,
    null_if_token,
    qcol,
    round_half_even,
)
