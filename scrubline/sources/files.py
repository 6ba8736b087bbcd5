"""Files under the shared folder that tasks read or write themselves."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

# Executors need not have this package installed: what runs in tasks travels along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(uri: str):
    """The file system and the path of a URI, as pyarrow names them."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", re.sub(r"^s3[an]:", "s3:", uri))
    return fs.FileSystem.from_uri(uri)
