"""Writers. All write in parallel; merging to one file is on request only."""
