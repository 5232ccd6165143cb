from tonguemill.streaming.incremental import once_per_key, read_new_files, translate_stream

__all__ = ["once_per_key", "read_new_files", "translate_stream"]
