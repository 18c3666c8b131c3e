"""Sources and sinks: CSV snapshots, landed JSON replies, Parquet datasets,
versioned warehouse tables, JDBC export, snapshot choice."""
