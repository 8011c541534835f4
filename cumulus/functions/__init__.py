"""Column-level helpers.  All return Spark ``Column`` expressions built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from .numeric import (per_capita, round_half_even, safe_div, weighted_sum)  # noqa: F401
from .dates import (add_days, bucket_cascade, date_text, lateness_edges,  # noqa: F401
                    lateness_label, lateness_of_days, month_label)
from .text import (band_label, display_string, first_match, parse_thousands,  # noqa: F401
                   str_trim, thousands)
from .predicates import (is_in, ne_and_not_null, nonzero, not_in_keep_null)  # noqa: F401
