"""Writers of raw rows, ranked tables, links, the dashboard and snapshots."""
