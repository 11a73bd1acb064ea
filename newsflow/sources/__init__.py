"""Scans: GKG TSV files, ragged text lines, zip archives, feed manifests, stream sources."""
