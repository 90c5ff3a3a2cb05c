"""Readers: raw log streams, rule tables and snapshots, flows, index documents."""
