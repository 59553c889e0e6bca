from runlens.streaming.stream import batch_handler, last_version, read_version, run_store_stream, run_stream

__all__ = ["batch_handler", "last_version", "read_version", "run_store_stream", "run_stream"]
