"""Table operators (DataFrame -> DataFrame)."""

from pricemart.operators.buckets import bucket_count, ranged, with_tie_break
from pricemart.operators.dedupe import keep_first, drop_duplicates_like
from pricemart.operators.fill import forward_fill, calendar_fill
from pricemart.operators.change import previous_value, next_value, pct_change, calendar_previous
from pricemart.operators.keys import with_surrogate_key
from pricemart.operators.resample import resample_monthly
from pricemart.operators.merge import priority_merge, source_cascade, tag_source
from pricemart.operators.quality import (
    drop_nulls, range_filter, record_is_valid, split_valid, quality_counts, non_empty, period_shape_ok,
    parse_then_filter,
)
