"""The retail queries. Each takes the tables and keyword arguments whose defaults are
the workload's standard parameters."""

from tillwise.plans.baskets import q00, q01, q29
from tillwise.plans.browsing import q02, q03, q04, q08, q12, q30
from tillwise.plans.channels import q06, q07, q09, q13, q14, q16, q17, q21, q22
from tillwise.plans.reviews import q10, q18, q19, q27, q28, q28_split
from tillwise.plans.segments import (
    q05,
    q05_features,
    q05_weights,
    q20,
    q20_features,
    q25,
    q25_features,
    q26,
    q26_features,
)
from tillwise.plans.trends import q11, q15, q23, q24

__all__ = [
    "q00", "q01", "q02", "q03", "q04", "q05", "q05_features", "q05_weights", "q06", "q07", "q08", "q09",
    "q10", "q11", "q12", "q13", "q14", "q15", "q16", "q17", "q18", "q19", "q20",
    "q20_features", "q21", "q22", "q23", "q24", "q25", "q25_features", "q26",
    "q26_features", "q27", "q28", "q28_split", "q29", "q30",
]
