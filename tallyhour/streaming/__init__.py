from tallyhour.streaming.events_stream import events_stream_query, run_available_now  # noqa: F401
