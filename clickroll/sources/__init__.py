from clickroll.sources.adapters import (  # noqa: F401
    EventSource, clickstream_source, lineitem_source, read_table,
)
from clickroll.sources.files import (  # noqa: F401
    read_events_csv, read_feature_table, write_events_csv, read_features_versioned, read_predictions_csv,
    write_feature_table, write_predictions_csv,
)
