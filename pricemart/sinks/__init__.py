"""Writers: snapshots, warehouse tables, insert-if-empty."""
