"""scrubline: table cleaning, exploration and stream ingestion on Spark.

Every operator is a native Spark expression or DataFrame transformation; the
subpackages are ``sources`` (scans, staging, stream sources), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame), ``plans``
(composite jobs) and ``streaming`` (micro-batch ingestion and sinks)."""

from .operators import *  # noqa: F401,F403
from .plans import CleanSpec, clean, explore, produce  # noqa: F401
from .session import local_session, shared_path, shared_root  # noqa: F401
from .sources import (insert_into, read_table, stage_like, stage_table,  # noqa: F401
                      stream_source)
from .streaming import (decode_stream, dedupe_stream, latest_by_key, read_sink,  # noqa: F401
                        run_ingest, stream_sink, write_batch)
