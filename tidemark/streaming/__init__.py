from tidemark.streaming.microbatch import landed_files, load_stream  # noqa: F401
