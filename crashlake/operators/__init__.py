from crashlake.operators.dedupe import distinct_values, keep_smallest
from crashlake.operators.joins import dimension_join
from crashlake.operators.keys import dense_index

__all__ = ["dense_index", "keep_smallest", "distinct_values", "dimension_join"]
