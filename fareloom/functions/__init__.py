from fareloom.functions.columns import day_name, elapsed, key_bucket, speed, total

__all__ = ["day_name", "elapsed", "key_bucket", "speed", "total"]
