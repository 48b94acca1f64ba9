from eventmart.streaming.family import end_waits, stream_family
from eventmart.streaming.intake import stream_feed

__all__ = ["end_waits", "stream_family", "stream_feed"]
