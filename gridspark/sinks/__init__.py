"""Published tables, rejection reports and manifests."""
