"""Column-expression builders.  Everything here returns a ``Column`` built from
``pyspark.sql.functions``; nothing runs Python per row."""

from ratecraft.functions.expressions import (
    safe_ratio, age_rule, age_fill_flag, fill_flag, score_from_probability,
    vector_element, label_to_double, hash_split_bucket, is_train_row, null_guard,
)

__all__ = [
    "safe_ratio", "age_rule", "age_fill_flag", "fill_flag",
    "score_from_probability", "vector_element", "label_to_double", "hash_split_bucket",
    "is_train_row", "null_guard",
]
