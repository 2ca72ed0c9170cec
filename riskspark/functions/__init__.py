from riskspark.functions.hashing import hash32, hash32_value, HASH_SPACE
from riskspark.functions.columns import r6, dot, sigmoid, softplus, threshold_grid, bucket_of_score

__all__ = ["hash32", "hash32_value", "HASH_SPACE", "r6", "dot", "sigmoid", "softplus",
           "threshold_grid", "bucket_of_score"]
