"""Where listings, manifests and plans come from and go to."""
