"""The relational part: plans, snapshots, merges, anchors, external events, goals."""
