"""Telemetry column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tessera.functions.text import py_strip

# The fields a monitor line carries after the device id, in
# order, and the two banner patterns (driver version up to the next blank,
# CUDA version greedy up to the last blank of its line).
MONITOR_FIELDS = [
    "timestamp",
    "gpu_utilization",
    "gpu_memory_used",
    "gpu_memory_total",
    "cpu_utilization",
    "ram_used",
    "ram_total",
]
DRIVER_VERSION_PATTERN = "Driver Version: (.+?) "
CUDA_VERSION_PATTERN = "CUDA Version:(.*) "
TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm:ss"
# whitespace removed by ``bytes.strip()``
ASCII_WHITESPACE = " \t\n\r\x0b\x0c"

# ``(?d)``: only a line feed ends a line, as in a Python bytes pattern
_UNIX_LINES = "(?d)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line) -> Column:
    """H3: split on commas and strip every field (Python whitespace)."""
    return F.transform(F.split(_col(line), ",", -1), lambda x: py_strip(x))


def drop_subseconds(ts_text) -> Column:
    """The text before the first ``.``."""
    return F.substring_index(_col(ts_text), ".", 1)


def parse_timestamp(ts_text, strict: bool = False) -> Column:
    """``%Y/%m/%d %H:%M:%S``; null on a bad value unless ``strict``."""
    fmt = F.lit(TIMESTAMP_FORMAT)
    return F.to_timestamp(_col(ts_text), fmt) if strict else F.try_to_timestamp(_col(ts_text), fmt)


def to_number(text, strict: bool = False) -> Column:
    """``float(x)``; null on a bad value (``[N/A]``) unless ``strict``."""
    c = _col(text)
    return c.cast("double") if strict else c.try_cast("double")


def percent_text(v) -> Column:
    """``'%2.1f%%' % v``."""
    return F.format_string("%2.1f%%", _col(v))


def megabytes_text(v) -> Column:
    """``'%dMB' % v`` (the value is truncated toward zero)."""
    return F.format_string("%dMB", _col(v).cast("bigint"))


def _strip_ascii(c: Column) -> Column:
    return F.trim(c, F.lit(ASCII_WHITESPACE))


def driver_version(banner) -> Column:
    """Driver version from the banner text (null when absent)."""
    b = _col(banner)
    p = _UNIX_LINES + DRIVER_VERSION_PATTERN
    return F.when(b.rlike(p), _strip_ascii(F.regexp_extract(b, p, 1)))


def cuda_version(banner) -> Column:
    """CUDA version from the banner text (null when absent)."""
    b = _col(banner)
    p = _UNIX_LINES + CUDA_VERSION_PATTERN
    return F.when(b.rlike(p), _strip_ascii(F.regexp_extract(b, p, 1)))
