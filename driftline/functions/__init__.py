"""Column-expression helpers (all JVM-side built-ins)."""

from driftline.functions.numeric import (  # noqa: F401
    round_half_even, is_finite_value, ordered_sum_expr, significant,
)
from driftline.functions.severity import (  # noqa: F401
    rank_of, status_of, psi_severity,
)
from driftline.functions.kolmogorov import (  # noqa: F401
    kolmogorov_sf_expr, ks_pvalue_exact, ks_pvalue_asymp,
)
