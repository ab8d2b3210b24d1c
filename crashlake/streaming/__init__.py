from crashlake.streaming.refresh import accident_refresh, refresh_batch

__all__ = ["accident_refresh", "refresh_batch"]
