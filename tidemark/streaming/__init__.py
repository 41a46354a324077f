"""Incremental runs of batch stages over folders that grow. The engine itself needs no stream: this is an extension."""
