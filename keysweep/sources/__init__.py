"""Sources: catalog scans, key lists, manifests, stage and backup reads."""
