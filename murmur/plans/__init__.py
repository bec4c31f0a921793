"""The jobs: mention view, dashboard, exports, query catalogue."""
