"""Batch and streaming sources, table staging."""

from .evolving_table import EvolvingTable, Field
from .keyed_table import KeyedTable
from .record_log import RecordLog, append_log, log_source, read_log, stream_log
from .streams import kafka_source, landing_source, record_source, stream_source
from .tables import insert_into, read_table, stage_like, stage_table

__all__ = ["EvolvingTable", "Field", "KeyedTable", "RecordLog", "append_log", "insert_into",
           "kafka_source", "landing_source",
           "log_source", "read_log", "read_table", "record_source", "stage_like", "stage_table",
           "stream_log", "stream_source"]
