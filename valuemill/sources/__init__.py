from valuemill.sources.catalog import Catalog
from valuemill.sources.csv_split import infer_types, read_csv_inferred, read_csv_split
from valuemill.sources.files import read_csv, read_optional, read_table, write_csv, write_table
from valuemill.sources.bucketed_store import BucketedStore
from valuemill.sources.keyed_store import KeyedStore
from valuemill.sources.landing import decode_binary, land, rename_tail
from valuemill.sources.request_log import append_requests, read_day, read_log, read_yesterday

__all__ = [
    "Catalog", "BucketedStore", "KeyedStore", "read_csv", "read_optional", "read_table", "write_csv", "write_table",
    "infer_types", "read_csv_inferred", "read_csv_split",
    "decode_binary", "land", "rename_tail", "append_requests", "read_day", "read_log", "read_yesterday",
]
