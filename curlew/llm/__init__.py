"""Operators of a large-scale training-data pipeline. Nothing outside this subpackage imports it."""

import curlew  # noqa: F401  registers the package for pickling by value
