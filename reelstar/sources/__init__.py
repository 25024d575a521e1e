"""Sources: raw landing-zone readers, landing writers, test-data adapter."""
