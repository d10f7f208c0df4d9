from clickroll.functions.exprs import (  # noqa: F401
    clip, entropy_term, expm1, finite_or_zero, log1p_clipped, log1p_plain,
    per_nonzero, round6, safe_ratio,
)
from clickroll.functions.schema import (  # noqa: F401
    TIME_CANDIDATES, TIME_CANDIDATES_SHORT, detect_time_column, feature_columns,
    numeric_only, require_columns,
)
