from tallyweave.functions.bands import (
    age_band_5,
    age_band_10,
    binary_code,
    code_group,
    label_code,
    size_stratum,
    urban_rural,
)
from tallyweave.functions.fields import (
    composite_id,
    digit_runs,
    first_present,
    fixed_width,
    id_text,
    name_part,
    pad_code,
    pair_key,
    strip_commas,
    strip_dots,
    strip_point_zero,
    upper_trim,
    with_trimmed_text,
)
from tallyweave.functions.numbers import (
    exact_sum,
    factor_or_one,
    is_whole_number,
    round_half_even,
    safe_ratio,
    to_int,
    to_number,
)
from tallyweave.functions.periods import half_of_month, half_of_quarter, quarter_of_month, stamp

__all__ = [
    "age_band_5",
    "age_band_10",
    "binary_code",
    "code_group",
    "composite_id",
    "digit_runs",
    "exact_sum",
    "factor_or_one",
    "first_present",
    "fixed_width",
    "half_of_month",
    "half_of_quarter",
    "id_text",
    "is_whole_number",
    "label_code",
    "name_part",
    "pad_code",
    "pair_key",
    "quarter_of_month",
    "round_half_even",
    "safe_ratio",
    "size_stratum",
    "stamp",
    "strip_commas",
    "strip_dots",
    "strip_point_zero",
    "to_int",
    "to_number",
    "upper_trim",
    "urban_rural",
    "with_trimmed_text",
]
