from strata.streaming.files import dedupe_late, file_stream, run_stream
from strata.streaming.prices import held_prices, latest_price_changes, run_latest_prices

__all__ = ["dedupe_late", "file_stream", "run_stream", "held_prices", "latest_price_changes", "run_latest_prices"]
