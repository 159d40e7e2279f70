from carelake.operators.arrays import (ordered_array, ordered_array_parts, distinct_array,  # noqa: F401
                                      ordered_distinct_concat, sorted_text)
from carelake.operators.latest import latest_row, top_n_by_key  # noqa: F401
from carelake.operators.aggregates import any_flags, attach, pivot_latest, spread  # noqa: F401
