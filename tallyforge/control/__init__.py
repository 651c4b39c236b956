"""Driver-side documents of a run: configuration, logs, manifests, runtime, reports, release gates and the command line."""
