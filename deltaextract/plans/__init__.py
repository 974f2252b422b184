from deltaextract.plans.feed import FeedRun, run_feed
from deltaextract.plans.presets import PRESETS, feed_from_preset

__all__ = ["PRESETS", "FeedRun", "feed_from_preset", "run_feed"]
