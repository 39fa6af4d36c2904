"""Scans: archives, text members, index and filing text, links, mapping responses, manifests, lake."""
