from liftworks.functions.columns import (  # noqa: F401
    binary_map,
    clip,
    is_missing,
    label_code,
    missing_to_null,
    one_hot,
    per_hundred,
    remap_level,
    round_digits,
    round_step,
    text_or_nan,
    to_number,
)
