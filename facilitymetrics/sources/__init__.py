"""Lake layers: paths, readers, writers, type boundary and audits."""
