"""Readers and writers: nested exports, binary and text trees, content store, pages, manifests."""
