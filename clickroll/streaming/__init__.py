from clickroll.streaming.incremental import refresh_session_features, start_session_feature_stream  # noqa: F401
